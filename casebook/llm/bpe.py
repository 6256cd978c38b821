"""Byte-level BPE by DuckDB recursive queries inside Spark's tasks.

Encoding.  A text is cut by the vocabulary's pattern.  Distinct words that are not
tokens themselves become token-position rows, one per byte; a recursive query
joins neighbours to the merge table, finds every word's leftmost pair of the
smallest rank, contracts it, and repeats until no pair is left.  Words are
handled once per task batch and kept in a bounded table between batches.

Decoding.  Token-position rows join the vocabulary; an aggregate ordered by position
puts the bytes of a document together.

Defined results: a null or empty text has no ids and decodes to no bytes; every
row is encoded on its own, repeated rows alike; the whole text is encoded,
whatever its length (texts are worked on in groups of about ``TEXT_GROUP`` characters,
so memory follows the longest text, not the batch); special tokens' strings are
ordinary text; a null id list decodes to no bytes, an id outside the vocabulary
raises; an empty table gives an empty result; extra columns stay untouched.
"""

from __future__ import annotations

import base64
import heapq
import re
import threading
from array import array
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import cached_property, lru_cache
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import prepare_workers

#: Characters of text that one query works on.  Each pass of the recursive query builds
#: a table of all merges, so texts go by more at a time, which new words are a small part of.
TEXT_GROUP = 4_000_000
#: Characters that are in pieces at a time, and ids that one query decodes: beside the tables, a worker holds little more.
GROUP = 250_000
#: Words, and pieces of text, that a worker keeps between batches; beyond, it starts anew.
KEPT_WORDS = 600_000
KEPT_PIECES = 500_000
#: Seconds without a batch after which a worker gives its tables back: Spark keeps idle workers for a
#: minute and hands them to other stages, beside whose own memory the tables would stand.
IDLE_SECONDS = 3.0
LONG_PIECE = 100
MARKS = ".,;:!?"
#: Bytes of distinct words in one recursive query.
QUERY_BYTES = 300_000
#: Longer words contract the same pairs from a heap: a query would need a pass over the word per pair.
LONG_WORD = 400

#: A token is the character with its id above this code point, so a word is a short string.
FIRST_CHARACTER = 0x10000

#: Token-position rows of every word that still changes join the merge table; the smallest
#: (rank, position) is its leftmost pair of the smallest rank, and is contracted.
ENCODE = f"""
WITH RECURSIVE steps(word, tokens) AS (
  SELECT word, tokens FROM given
  UNION ALL
  SELECT word, substring(tokens, 1, (best & 65535)::INTEGER - 1) || chr(({FIRST_CHARACTER} + (best >> 16))::INTEGER)
               || substring(tokens, (best & 65535)::INTEGER + 2)
  FROM (
    SELECT word, any_value(tokens) AS tokens, min((merged << 16) | pos) AS best
    FROM (SELECT word, tokens, unnest(range(1, length(tokens))) AS pos FROM steps)
    JOIN merges ON pair = substring(tokens, pos, 2)
    GROUP BY word
  )
)
SELECT word, arg_min(tokens, length(tokens)) AS tokens FROM steps GROUP BY word ORDER BY word
"""

DECODE = """
SELECT doc, array_to_string(list(bytes ORDER BY pos), '') AS bytes
FROM given JOIN vocabulary USING (id) GROUP BY doc ORDER BY doc
"""

#: A blank with no white space beside it; the pattern may join it to such.
LONE_BLANK = re.compile(r"(?<=[^\s\x1c-\x1f\x85]) (?=[^\s\x1c-\x1f\x85])")


def packed(ids: Iterable[int]) -> bytes:
    return array("i", ids).tobytes()


class Codec:
    """A vocabulary of ranks in an in-memory DuckDB of one thread."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.has = np.zeros(max(self.tokens) + 1, bool)
        self.has[list(self.tokens)] = True
        self.cut = regex.compile(pattern).findall
        self.single = np.array([FIRST_CHARACTER + self.ranks[bytes([i])] for i in range(256)], "<u4")
        self.known: dict[str, bytes] = {}  # piece of text, without its blank -> its ids
        self.words: dict[str, bytes] = {}  # word -> its ids, four bytes each
        pairs = list(self._pairs())
        self.db = duckdb.connect(":memory:", config={"threads": 1, "temp_directory": ""})
        self._store("merges", pa.table({
            "pair": pa.array([chr(FIRST_CHARACTER + a) + chr(FIRST_CHARACTER + b) for a, b, _ in pairs]),
            "merged": pa.array([rank for _, _, rank in pairs], pa.int64())}))
        self._store("vocabulary", pa.table({
            "id": pa.array(self.tokens, pa.int32()),
            "bytes": pa.array([t.decode("latin-1") for t in self.tokens.values()])}))  # a character per byte

    def _pairs(self) -> Iterator[tuple[int, int, int]]:
        """Every pair of tokens that is a token, and its rank."""
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                if (a := self.ranks.get(token[:k])) is not None and (b := self.ranks.get(token[k:])) is not None:
                    yield a, b, rank

    @cached_property
    def merge(self) -> dict[tuple[int, int], int]:
        """For long words alone, so it is made when the first one comes."""
        return {(a, b): rank for a, b, rank in self._pairs()}

    def _store(self, name: str, rows: pa.Table) -> None:
        self.db.register("loading", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM loading")
        self.db.unregister("loading")

    def _ask(self, sql: str, rows: pa.Table) -> dict[str, np.ndarray]:
        self.db.register("given", rows)
        try:
            return self.db.execute(sql).fetchnumpy()
        finally:
            self.db.unregister("given")

    def learn(self, texts: set[str]) -> None:
        """Encode words that are not known yet."""
        new = texts.difference(self.words)
        if len(self.words) + len(new) > KEPT_WORDS:
            self.words.clear()
            new = texts
        todo: list[tuple[str, bytes]] = []
        size = 0
        for text in new:
            raw = text.encode("utf-8", "surrogatepass")
            if (rank := self.ranks.get(raw)) is not None:
                self.words[text] = packed([rank])
            elif len(raw) > LONG_WORD:
                self.words[text] = packed(self.contract(raw))
            else:
                todo.append((text, raw))
                size += len(raw)
                if size >= QUERY_BYTES:
                    self._query(todo)
                    todo, size = [], 0
        if todo:
            self._query(todo)

    def _query(self, todo: list[tuple[str, bytes]]) -> None:
        # one character per byte, for all words at once, then cut back into words
        every = self.single[np.frombuffer(b"".join(raw for _, raw in todo), np.uint8)].tobytes().decode("utf-32-le")
        ends = np.cumsum([len(raw) for _, raw in todo]).tolist()
        out = self._ask(ENCODE, pa.table({
            "word": np.arange(len(todo), dtype=np.int32),
            "tokens": pa.array([every[a:b] for a, b in zip([0, *ends], ends, strict=False)])}))
        tokens = out["tokens"].tolist()
        ids = (np.frombuffer("".join(tokens).encode("utf-32-le"), "<u4") - FIRST_CHARACTER).astype(np.int32).tobytes()
        ends = np.cumsum([4 * len(t) for t in tokens]).tolist()
        self.words.update(
            (word, ids[a:b]) for (word, _), a, b in zip(todo, [0, *ends], ends, strict=False))

    def contract(self, raw: bytes) -> list[int]:
        """The query's rule for one long word: leftmost pair of the smallest rank, from a heap."""
        ids: list[int | None] = [self.ranks[bytes([c])] for c in raw]
        following, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(m, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False))
                if (m := self.merge.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            merged, i, a, b = heapq.heappop(heap)
            j = following[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue  # one of the two has been contracted since
            ids[i], ids[j], following[i] = merged, None, following[j]
            if following[j] < len(ids):
                before[following[j]] = i
            for x, y in ((before[i], i), (i, following[i])):
                if x >= 0 and y < len(ids) and (m := self.merge.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (m, x, ids[x], ids[y]))
        return [x for x in ids if x is not None]

    def pieces(self, texts: list[str]) -> tuple[list[str], set[int], set[str]]:
        """What stands before the first blank of each text, the texts that ``LONE_BLANK`` cuts, and the pieces not known yet.

        A blank between two characters that are no white space begins a match, so a text falls apart
        there and the pattern cuts each piece alike on its own.  If a piece shows white space at an end,
        the blank there may not be such a one, and that text is only cut where it is.
        """
        heads: list[str] = []
        careful: set[int] = set()
        new: set[str] = set()
        for a, b in _groups(map(len, texts), GROUP):
            rest = [text.split(" ") for text in texts[a:b]]
            first = [pieces.pop(0) for pieces in rest]
            unknown = set(chain.from_iterable(rest)).difference(self.known)
            uneven = {x for x in chain(unknown, first) if not x or x.strip() != x}
            if uneven:
                for k, pieces in enumerate(rest):
                    if pieces and (first[k] in uneven or not uneven.isdisjoint(pieces)):
                        first[k], *rest[k] = LONE_BLANK.split(texts[a + k])
                        careful.add(a + k)
                unknown = set(chain.from_iterable(rest)).difference(self.known)
            heads += first
            new |= unknown
        return heads, careful, new

    def matches(self, piece: str) -> list[str]:
        """The pattern's matches in a blank and a piece; letters, and a mark behind them, need no search."""
        if piece.isalpha():
            return [" " + piece]
        if piece[-1] in MARKS and piece[:-1].isalpha():
            return [" " + piece[:-1], piece[-1]]
        return self.cut(" " + piece)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        heads, careful, new = self.pieces(texts)
        if len(self.known) + len(new) > KEPT_PIECES:
            self.known.clear()
            heads, careful, new = self.pieces(texts)
        parts = [self.matches(piece) for piece in new]
        first = [self.cut(head) for head in heads]
        self.learn(set(chain.from_iterable(chain(parts, first))))
        ids = self.words.__getitem__
        self.known.update(zip(new, [
            ids(words[0]) if len(words) == 1 else b"".join(map(ids, words)) for words in parts], strict=True))
        known = self.known.__getitem__
        # the texts fall apart once more, one at a time: the pieces of all would stand beside the tables
        out = [np.frombuffer(b"".join(chain(map(ids, words), map(known, (
            LONE_BLANK.split(text) if k in careful else text.split(" "))[1:]))), "=i4")
               for k, (words, text) in enumerate(zip(first, texts, strict=True))]
        for piece in [x for x in new if len(x) > LONG_PIECE or x.strip() != x]:
            del self.known[piece]
        return out

    def decode(self, lists: list[np.ndarray]) -> list[bytes]:
        lengths = np.array([len(x) for x in lists], np.int64)
        ids = np.concatenate(lists) if lists else np.zeros(0, np.int32)
        if not len(ids):
            return [b""] * len(lists)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        out = self._ask(DECODE, pa.table({
            "doc": np.repeat(np.arange(len(lists), dtype=np.int32), lengths),
            "pos": (np.arange(len(ids)) - np.repeat(starts, lengths)).astype(np.int32), "id": ids}))
        inside = (ids >= 0) & (ids < len(self.has))
        if not (inside.all() and self.has[ids].all()):
            raise ValueError(f"no such token id: {min(set(ids.tolist()) - self.tokens.keys())}")
        text = dict(zip(out["doc"].tolist(), out["bytes"], strict=True))
        return [text.get(i, "").encode("latin-1") for i in range(len(lists))]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One per worker process and vocabulary."""
    return Codec(path, pattern)


_idle: threading.Timer | None = None


def _forget() -> None:
    """Drop the kept codecs; a batch that still works with one keeps its own until it ends."""
    codec.cache_clear()


@contextmanager
def codec_at_work(path: str, pattern: str) -> Iterator[Codec]:
    """The worker's codec for one batch.  It stays for the next one, of any task, that begins within IDLE_SECONDS."""
    global _idle
    if _idle is not None:
        _idle.cancel()
    try:
        yield codec(path, pattern)
    finally:
        pa.default_memory_pool().release_unused()
        _idle = threading.Timer(IDLE_SECONDS, _forget)
        _idle.daemon = True
        _idle.start()


def _groups(lengths: Iterable[int], most: int | None = None) -> list[tuple[int, int]]:
    """Runs of rows of about ``most`` (GROUP) together, or one longer row."""
    most = most or GROUP
    out, first, size, n = [], 0, 0, 0
    for n, length in enumerate(lengths, 1):
        size += length
        if size >= most:
            out.append((first, n))
            first, size = n, 0
    return [*out, (first, n)] if first < n else out


def _text_groups(texts: pa.Array) -> Iterator[list[str]]:
    """The texts (null: empty) in runs of about TEXT_GROUP bytes; only one run is in Python strings at a time."""
    for a, b in _groups(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), TEXT_GROUP):
        yield [t or "" for t in texts.slice(a, b - a).to_pylist()]


def _lists(ids: list[np.ndarray], sizes: list[int]) -> pa.ListArray:
    return pa.ListArray.from_arrays(
        np.cumsum(sizes).astype(np.int32), np.concatenate([np.zeros(0, np.int32), *ids]))


def encode(text: Column, path: str, pattern: str) -> Column:
    """array<int> of token ids."""
    prepare_workers()

    @F.arrow_udf("array<int>")
    def bpe_encode(texts: pa.Array) -> pa.Array:
        ids, sizes = [], [0]
        with codec_at_work(path, pattern) as used:
            for group in _text_groups(texts):
                lists = used.encode(group)
                sizes += [len(x) for x in lists]
                ids.append(np.concatenate([np.zeros(0, np.int32), *lists]))
        return _lists(ids, sizes)

    return bpe_encode(text)


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """struct<ids: array<int>, decoded: binary>: encode, and decode what came out, in one pass."""
    prepare_workers()

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def bpe_round_trip(texts: pa.Array) -> pa.Array:
        ids, sizes, decoded = [], [0], []
        with codec_at_work(path, pattern) as used:
            for group in _text_groups(texts):
                lists = used.encode(group)
                decoded += [pa.array(used.decode(lists[a:b]), pa.binary()) for a, b in _groups(map(len, lists))]
                sizes += [len(x) for x in lists]
                ids.append(np.concatenate([np.zeros(0, np.int32), *lists]))
        return pa.StructArray.from_arrays(
            [_lists(ids, sizes), pa.concat_arrays([pa.array([], pa.binary()), *decoded])], ["ids", "decoded"])

    return bpe_round_trip(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """binary: the bytes of a list of token ids."""
    prepare_workers()

    @F.arrow_udf("binary")
    def bpe_decode(lists: pa.Array) -> pa.Array:
        offsets = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False)
        absent = lists.is_null().to_pylist()
        rows = [values[:0] if none else values[a:b]
                for none, a, b in zip(absent, offsets, offsets[1:], strict=False)]
        with codec_at_work(path, pattern) as used:
            out = [x for a, b in _groups(map(len, rows)) for x in used.decode(rows[a:b])]
        return pa.array(out, pa.binary())

    return bpe_decode(ids)
