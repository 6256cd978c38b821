"""Periodic runs of words: internal pattern matching with a wavelet tree over the suffix array.

A run is a longest stretch of consecutive words with smallest period q (words q apart
are identical) of at least ``max(least, times * q)`` words, ``times`` being 3 or more.

Search.  The texts of an Arrow batch are one sequence of symbols, a symbol being a word
of one text.  Prefix doubling sorts the suffixes and leaves, for every power of two, the
rank of the block of that length at every position (equal blocks, equal ranks): the
blocks of one rank are an interval of the suffix array.  A run of period q holds an
aligned block of B words, B the largest power of two up to q, that occurs again q words
later, in the neighbouring window of starts [p + B, p + 2B).  Every aligned block asks a
wavelet tree over the suffix array for its occurrences there: the range successor gives
the first, counts give their number, the last, and the second.  In so short a window they
are an arithmetic progression.  One or two occurrences give their distances as candidate
periods; three or more mean that the block repeats within itself, and the candidates are
the distances between the ends, and between the beginnings, of the two stretches that
repeat so.  Every candidate is extended to both sides by comparing block ranks from long
to short, and kept if it is long enough; the smallest period of a stretch stands.

Work and memory follow the batch (n log n); a text is never cut, so a very long one is a
batch of its own.  Words are compared by 64-bit hashes inside one text.

Defined results: null and empty texts have no word and no run, and collapse to the
empty text; repeated rows are alike; an empty table gives an empty result; extra columns
are untouched (the operator is a column).  In the collapsed text the words that a run
holds after its first q are gone, the others are joined by one space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import BLANKS, prepare_workers
from .word_arrays import classes, cut

LEAST = 24
TIMES = 3

SCHEMA = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


class WaveletTree:
    """Values 0 .. 2**bits - 1 in order of the suffix array, by bit from the highest."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.levels: list[tuple[np.ndarray, int]] = []  # zeros before every place, zeros in all
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~ones, out=zeros[1:])
            self.levels.append((zeros, int(zeros[-1])))
            values = np.concatenate((values[~ones], values[ones]))

    def below(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many values of [left, right) are below the limit, for each query."""
        found = np.zeros(len(left), np.int32)
        over = limit >> self.bits > 0
        for level, (zeros, all_zeros) in enumerate(self.levels):
            one = (limit >> (self.bits - 1 - level) & 1).astype(bool)
            a, b = zeros[left], zeros[right]
            found += np.where(one, b - a, 0).astype(np.int32)
            left = np.where(one, all_zeros + left - a, a)
            right = np.where(one, all_zeros + right - b, b)
        return np.where(over, -1, found)

    def smallest(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value number k (from 0) of [left, right) in ascending order."""
        value = np.zeros(len(left), np.int64)
        for zeros, all_zeros in self.levels:
            a, b = zeros[left], zeros[right]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            left = np.where(one, all_zeros + left - a, a)
            right = np.where(one, all_zeros + right - b, b)
            value = value * 2 + one
        return value


class Blocks:
    """Suffix array of a sequence, and the rank of every block of 2**j symbols.

    ``symbols`` are dense numbers from 0.  A rank is the block's first place in the suffix
    array; ``sizes[j]`` by rank is how many equal blocks there are.  Blocks that pass the end
    of the sequence differ from all others.
    """

    def __init__(self, symbols: np.ndarray, levels: int):
        n = self.n = len(symbols)
        order = np.argsort(symbols, kind="stable").astype(np.int32)
        rank = self._heads(symbols[order], order, np.empty(n, np.int32))
        self.ranks, self.order = [rank], order
        self.sizes = [np.bincount(rank, minlength=n).astype(np.int32)]
        for level in range(1, levels):
            width, sizes = 1 << (level - 1), self.sizes[-1]
            open_ = np.flatnonzero(sizes[rank] > 1).astype(np.int32)  # positions that are not yet alone
            rank = rank.copy()
            if len(open_):
                after = open_ + width
                second = np.where(after < n, rank[np.minimum(after, n - 1)].astype(np.int64), n + after.astype(np.int64))
                keys = rank[open_].astype(np.int64) * (3 * n) + second
                by_key = np.argsort(keys, kind="stable")
                places = np.sort(rank[open_], kind="stable")  # equal ranks lie together ...
                firsts = np.concatenate(([True], places[1:] != places[:-1]))
                at = np.arange(len(places), dtype=np.int32)
                places = places + at - np.maximum.accumulate(np.where(firsts, at, 0))  # ... from their first place on
                order = order.copy()
                order[places] = open_[by_key]
                keys = keys[by_key]
                new = np.concatenate(([True], keys[1:] != keys[:-1]))
                rank[open_[by_key]] = np.maximum.accumulate(np.where(new, places, 0))
            self.ranks.append(rank)
            self.sizes.append(np.bincount(rank, minlength=n).astype(np.int32))
        self.order = order

    @staticmethod
    def _heads(keys: np.ndarray, order: np.ndarray, out: np.ndarray) -> np.ndarray:
        if len(keys):
            new = np.concatenate(([True], keys[1:] != keys[:-1]))
            out[order] = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
        return out

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols are equal from a and from b (a < b) on."""
        return self._extended(a, b, 1)

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols are equal before a and before b (a < b)."""
        return self._extended(a, b, -1)

    def _extended(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        gained = np.zeros(len(a), np.int64)
        top = len(self.ranks) - 1
        more = np.arange(len(a))
        while len(more):  # whole blocks of the longest kind; a stretch has few of them
            more = more[self._same(a[more], b[more], gained[more], top, way)]
            gained[more] += 1 << top
        for level in range(top - 1, -1, -1):
            gained += self._same(a, b, gained, level, way).astype(np.int64) << level
        return gained

    def _same(self, a: np.ndarray, b: np.ndarray, gained: np.ndarray, level: int, way: int) -> np.ndarray:
        """Whether the blocks of 2**level behind (or before) what is gained are inside and equal."""
        width, rank = 1 << level, self.ranks[level]
        a, b = (a + gained, b + gained) if way > 0 else (a - gained - width, b - gained - width)
        fits = (a >= 0) & (b + width <= self.n)
        return fits & (rank[np.where(fits, a, 0)] == rank[np.where(fits, b, 0)])


def find(symbols: np.ndarray, longest: int, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period.

    ``longest`` bounds the length of a run (the longest text), symbols of different texts differ.
    """
    n = len(symbols)
    levels = max(1, (longest // times).bit_length())
    if n < least:
        return np.zeros((0, 3), np.int64)
    blocks = Blocks(symbols, levels)
    tree = WaveletTree(blocks.order)
    found = []
    for level in range(levels):
        width = 1 << level
        p = np.arange(0, n - width + 1, width, dtype=np.int64)
        rank, sizes = blocks.ranks[level], blocks.sizes[level]
        # a run holds at least so many copies of its first aligned block (period below 2 * width)
        copies = max(2, (least - 2 * width + 1) // (2 * width - 1) + 1)
        p = p[sizes[rank[p]] >= copies]
        if not len(p):
            continue
        left = rank[p].astype(np.int32)
        right = left + sizes[left]
        before = tree.below(left, right, np.minimum(p + width, n))
        until = tree.below(left, right, np.minimum(p + 2 * width, n))
        count = np.where(until < 0, right - left, until) - np.where(before < 0, right - left, before)
        some = count > 0
        p, left, right, before, count = (x[some] for x in (p, left, right, before, count))
        if not len(p):
            continue
        first = tree.smallest(left, right, before)  # the range successor of p + width
        last = first.copy()
        more = count > 1
        last[more] = tree.smallest(left[more], right[more], before[more] + count[more] - 1)
        candidates = [(p, first - p), (p[more], last[more] - p[more])]
        many = np.flatnonzero(count > 2)
        if len(many):
            p, first = p[many], first[many]
            step = tree.smallest(left[many], right[many], before[many] + 1) - first
            ends = [x + step + blocks.forward(x, x + step) for x in (p, first)]
            begins = [x - blocks.backward(x, x + step) for x in (p, first)]
            candidates += [(p, ends[1] - ends[0]), (p, begins[1] - begins[0])]
        for at, q in candidates:
            fits = (q >= width) & (q < 2 * width) & (at + q < n)
            at, q = at[fits], q[fits]
            start = at - blocks.backward(at, at + q)
            length = at + q + blocks.forward(at, at + q) - start
            good = length >= np.maximum(least, times * q)
            found.append(np.stack((start[good], length[good], q[good]), axis=1))
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    same = np.zeros(len(rows), bool)  # the same stretch: its smallest period comes first
    same[1:] = (rows[1:, :2] == rows[:-1, :2]).all(axis=1)
    rows = rows[~same]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def collapse_batch(texts: pa.Array, least: int = LEAST, times: int = TIMES) -> pa.Array:
    words = cut(texts, classes(BLANKS))
    n = len(words.starts)
    order = np.lexsort((words.hashes, words.text))
    new = np.ones(n, bool)
    new[1:] = (words.hashes[order][1:] != words.hashes[order][:-1]) | (words.text[order][1:] != words.text[order][:-1])
    symbols = np.empty(n, np.int64)
    symbols[order] = np.cumsum(new) - 1
    bounds = np.searchsorted(words.text, np.arange(len(texts) + 1))
    runs = find(symbols, int(np.diff(bounds).max(initial=0)), least, times)
    # words that a run holds after its first period
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
    # kept words and a blank behind each, but for a text's last
    lengths = (words.ends - words.starts)[kept]
    text = words.text[kept]
    final = np.ones(len(kept), bool)
    final[:-1] = text[1:] != text[:-1]
    sizes = lengths + ~final
    outs = np.zeros(len(kept) + 1, np.int64)
    np.cumsum(sizes, out=outs[1:])
    source = np.arange(outs[-1]) + np.repeat(words.starts[kept] - outs[:-1], sizes)
    data = words.raw[np.minimum(source, max(len(words.raw) - 1, 0))] if len(words.raw) else np.zeros(0, np.uint8)
    data[(outs[1:] - 1)[~final]] = ord(" ")
    offsets = outs[np.searchsorted(text, np.arange(len(texts) + 1))]
    collapsed = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    owner = words.text[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    fields = [pa.array(runs[:, 0] - bounds[owner]), pa.array(runs[:, 1]), pa.array(runs[:, 2])]
    rows = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32), rows)
    return pa.StructArray.from_arrays([lists, collapsed.cast(pa.string())], ["runs", "collapsed"])


def collapse(text: Column, least: int = LEAST, times: int = TIMES) -> Column:
    """struct<runs, collapsed> of a text column, in Arrow batches."""
    if times < 3:
        raise ValueError("a block and its copy fit in a run of three periods or more")
    prepare_workers()

    @F.arrow_udf(SCHEMA)
    def periodic_runs(texts: pa.Array) -> pa.Array:
        return collapse_batch(texts, least, times)

    return periodic_runs(text)


def plainest(runs: Column) -> Column:
    """The run with the greatest exact length / period of an array by start and period; the first of equals."""
    return F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)),
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best))
