"""Words of an Arrow batch of texts as numpy arrays: where they lie, and a 64-bit hash of each."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Classes of a byte.
BLANK, MARK, LETTER = 0, 1, 2
#: An odd factor, and values of the 256 bytes; any would do.
FACTOR = 0x9E3779B97F4A7C15
BYTE_VALUES = np.random.default_rng(64).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes that are hashed together, which keeps the arrays in the cache.
BLOCK = 1 << 16


class Words(NamedTuple):
    raw: np.ndarray  #: the bytes of all texts
    starts: np.ndarray  #: first byte of every word
    ends: np.ndarray
    text: np.ndarray  #: number of the text
    piece: np.ndarray | None  #: number of the piece; grows from text to text
    hashes: np.ndarray


def classes(blanks: str, marks: str = "") -> np.ndarray:
    table = np.full(256, LETTER, np.uint8)
    table[[ord(c) for c in blanks]] = BLANK
    table[[ord(c) for c in marks]] = MARK
    return table


def lowering() -> np.ndarray:
    """Byte table that lower-cases A-Z."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them over all bits."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit value of an ordered pair of them."""
    return mixed(a * np.uint64(FACTOR) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))


_powers: dict[str, np.ndarray] = {}


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    if not _powers:
        for name, base in (("up", FACTOR), ("down", pow(FACTOR, -1, 1 << 64))):
            table = np.full(BLOCK + 1, base, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table)
    return _powers["up"], _powers["down"]


#: Words up to so many bytes are hashed eight bytes at a time, all words at once.
SHORT = 128
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def hashed(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte range; ranges ascend and do not overlap."""
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[:len(raw)] = raw
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each byte on
    length = ends - starts
    out = (eight[starts] & LOW_BYTES[np.minimum(length, 8)]) * np.uint64(FACTOR)
    out += length.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    long = np.flatnonzero(length > SHORT)
    rest, at = np.flatnonzero((length > 8) & (length <= SHORT)), 8
    while len(rest):
        out[rest] = mixed(out[rest]) + (eight[starts[rest] + at] & LOW_BYTES[np.minimum(length[rest] - at, 8)]) * np.uint64(FACTOR)
        at += 8
        rest = rest[length[rest] > at]
    out = mixed(out)
    if len(long):
        out[long] = _hashed_by_blocks(raw, starts[long], ends[long])
    return out


def _hashed_by_blocks(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of every byte range, spread by ``mixed``; ranges ascend and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    up, down = _power_tables()
    first = 0
    while first < len(starts):
        at = int(starts[first])
        last = int(np.searchsorted(ends, at + BLOCK, side="right"))
        if last <= first:  # a word longer than a block: hashed in blocks, one after the other
            h = np.uint64(0)
            for a in range(at, int(ends[first]), BLOCK):
                part = raw[a:min(a + BLOCK, int(ends[first]))]
                h = mixed(np.array([h + (BYTE_VALUES[part] * up[:len(part)]).sum(dtype=np.uint64)], np.uint64))[0]
            out[first] = h
            first += 1
            continue
        stop = int(ends[last - 1])
        sums = np.zeros(stop - at + 1, np.uint64)
        np.cumsum(BYTE_VALUES[raw[at:stop]] * up[:stop - at], out=sums[1:])
        a, b = starts[first:last] - at, ends[first:last] - at
        out[first:last] = (sums[b] - sums[a]) * down[a]
        first = last
    return mixed(out)


def cut(texts: pa.Array, table: np.ndarray, lower: np.ndarray | None = None) -> Words:
    """The words of all texts (null: none): longest runs of LETTER bytes inside a text."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) \
        else np.zeros(1, np.int64)
    data = texts.buffers()[2] if len(texts) else None
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower is not None:
        raw = lower[raw]
    kinds = table[raw]
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = kinds == LETTER
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    joints = offsets[1:-1]  # a text may end and the next begin inside one run
    joints = np.unique(joints[inside[joints] & inside[joints + 1]])
    starts, ends = (np.insert(x, np.searchsorted(x, joints), joints) if len(joints) else x for x in (edges[::2], edges[1::2]))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
    piece = None
    if (table == MARK).any():
        piece = np.cumsum(kinds == MARK, dtype=np.int32)[starts] + text  # no word begins at a mark
    return Words(raw, starts, ends, text, piece, hashed(raw, starts, ends))


class Sums:
    """Counts by id, with further columns that an id determines."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, ids: np.ndarray, *columns: np.ndarray, n: np.ndarray | None = None) -> None:
        if len(ids):
            by_id = np.argsort(ids)
            ids = ids[by_id]
            firsts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            n = np.diff(firsts, append=len(ids)) if n is None else np.add.reduceat(n[by_id], firsts)
            self.parts.append((ids[firsts], *(c[by_id[firsts]] for c in columns), n))
            self.held += len(firsts)

    def taken(self) -> tuple[np.ndarray, ...]:
        """(*columns, n), and start anew."""
        ids, *columns, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.held = [], 0
        self.add(ids, *columns, n=n)
        (_, *out), = self.parts
        self.parts, self.held = [], 0
        return tuple(out)
