"""Maximal periodic runs of words, found by internal pattern matching.

The words of many documents are numbered and their suffixes sorted by doubling, each document for itself; round k gives
every position the rank of its 2^k words. Dyadic blocks (2^k words at multiples of 2^k) then ask for their occurrences
in the window behind them: the block's suffix array interval is known from its rank, and a wavelet matrix over the
suffix array answers "the next position from x on in this interval" (range successor). Occurrences at equal steps are
one progression, whose step is the only candidate period in it. Extending the candidate to both sides gives the run.

A run of period q holds an aligned block of b words together with that block's copy q words on, for the largest power
of two b with 2 b - 1 <= 3 q. So blocks of b words need to look only for periods from (2 b - 1) / 3 to (4 b - 2) / 3.
Everything happens where a document is read: nothing is shuffled, and memory is bounded by CHUNK_WORDS or one document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Words that are sorted together; a longer document is taken by itself.
CHUNK_WORDS = 1 << 18
#: A run has at least this many words, and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4


class _Successor:
    """Wavelet matrix: the least value from x on among values[left:right], for many queries at once."""

    def __init__(self, values: np.ndarray) -> None:
        self.size = len(values)
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros: list[tuple[np.ndarray, int]] = []
        for bit in reversed(range(self.bits)):
            one = (values >> bit) & 1
            before = np.concatenate([[0], np.cumsum(1 - one)]).astype(np.int32)
            self.zeros.append((before, int(before[-1])))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def _below(self, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
        less = np.zeros(len(x), np.int64)
        for bit, (before, total) in zip(reversed(range(self.bits)), self.zeros, strict=True):
            low, high = before[left], before[right]
            one = (x >> bit) & 1 == 1
            less += np.where(one, high - low, 0)
            left, right = np.where(one, total + left - low, low), np.where(one, total + right - high, high)
        return np.where(x >> self.bits > 0, -1, less)

    def __call__(self, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
        """-1 where there is no such value."""
        place = self._below(left, right, x)
        found = (place >= 0) & (place < right - left)
        place, left, right = np.where(found, place, 0), np.where(found, left, 0), np.where(found, right, self.size)
        value = np.zeros(len(x), np.int64)
        for bit, (before, total) in zip(reversed(range(self.bits)), self.zeros, strict=True):
            low, high = before[left], before[right]
            one = place >= high - low
            value |= np.where(one, 1 << bit, 0)
            place = np.where(one, place - (high - low), place)
            left, right = np.where(one, total + left - low, low), np.where(one, total + right - high, high)
        return np.where(found, value, -1)


def _group_ranks(key: np.ndarray, base: np.ndarray | int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, rank of every row of order, size of its group): rows of equal key share base plus the group's place."""
    order = np.argsort(key)
    new = np.concatenate([[True], np.diff(key[order]) != 0])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(key)))
    group = np.cumsum(new) - 1
    return order, first[group] + base, size[group]


def _sort_suffixes(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(suffix array, ranks by 1, 2, 4, ... words, how many positions share the rank by 2 words).

    words differ between documents, so do their ranks; ends[i] is the end of i's document. Blocks that reach beyond it
    equal no other.
    """
    n = len(words)
    order, ranked, size = _group_ranks(words, 0)
    suffixes = order.copy()
    rank = np.empty(n, np.int32 if n < 1 << 31 else np.int64)
    rank[order] = ranked
    ranks, many, step = [rank], np.ones(n, np.int64), 1
    open_ = order[size > 1]
    while len(open_) or len(ranks) == 1:
        rank = rank.copy()
        if len(open_):
            ahead = open_ + step
            second = np.where(ahead < ends[open_], ranks[-1][np.minimum(ahead, n - 1)].astype(np.int64) + 1, 0)
            # open_ is sorted by rank, so the place inside the old group plus its rank is the place in the suffix array
            old = ranks[-1][open_].astype(np.int64)
            start = np.flatnonzero(np.concatenate([[True], np.diff(old) != 0]))
            base = np.repeat(old[start] - start, np.diff(np.append(start, len(old))))
            order, ranked, size = _group_ranks(old * (n + 1) + second, 0)
            open_ = open_[order]
            suffixes[np.arange(len(open_)) + base] = open_
            rank[open_] = ranked + base
            if step == 1:
                many[open_] = size
            open_ = open_[size > 1]
        ranks.append(rank)
        step *= 2
    return suffixes, ranks, many


def _common(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
    """How many words from i on (or before i) equal those from j on (or before j), for i < j."""
    n = len(ranks[0])
    total = np.zeros(len(i), np.int64)
    for k in reversed(range(len(ranks))):
        step = 1 << k
        a, b = (i + total, j + total) if forward else (i - total - step, j - total - step)
        fits = (b < n) if forward else (a >= 0)
        same = fits & (ranks[k][np.where(fits, a, 0)] == ranks[k][np.where(fits, b, 0)])
        total += np.where(same, step, 0)
    return total


def find_runs(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period; words as in _sort_suffixes."""
    n = len(words)
    none = np.empty(0, np.int64)
    if not n:
        return none, none, none
    suffixes, ranks, many = _sort_suffixes(words, ends)
    repeated = many[suffixes] > 1  # whose first two words come again in their document
    if not repeated.any():
        return none, none, none
    place = np.concatenate([[0], np.cumsum(repeated)])
    successor = _Successor(suffixes[repeated])
    found = [(none, none, none)]
    for k in range(1, len(ranks)):
        block, rank = 1 << k, ranks[k]
        shared = np.bincount(rank, minlength=n)
        at = np.arange(0, n, block)
        at = at[shared[rank[at]] > 1]
        shortest, longest = -(-(2 * block - 1) // 3), (4 * block - 2) // 3
        left, right, x = place[rank[at]], place[rank[at] + shared[rank[at]]], at + 1
        while len(at):
            there = successor(left, right, x)
            near = (there >= 0) & (there <= at + longest)
            at, left, right, there = at[near], left[near], right[near], there[near]
            period = there - at
            after = _common(ranks, at, there, True)
            fits = period >= shortest
            before = _common(ranks, at[fits], there[fits], False)
            start, length = at[fits] - before, before + period[fits] + after[fits]
            enough = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period[fits])
            found.append((start[enough], length[enough], period[fits][enough]))
            x = at + (after + period - block) // period * period + 1  # behind the progression
    start, length, period = (np.concatenate(column) for column in zip(*found, strict=True))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.concatenate([[True], (np.diff(start) != 0) | (np.diff(length) != 0)])[: len(start)]
    start, length, period = start[first], length[first], period[first]  # of equal stretches the smallest period
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _chunk(ids: list, split: list[list[bytes]]) -> pa.RecordBatch:
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    sizes = np.array([len(words) for words in split], np.int64)
    ends = np.cumsum(sizes)
    words = np.array([number[w] for one in split for w in one], np.int64)
    start, length, period = find_runs(words + np.repeat(np.arange(len(split)), sizes) * (len(number) + 1), np.repeat(ends, sizes))
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    dropped = np.cumsum(change)[:-1] > 0
    of = np.searchsorted(ends, start, side="right")
    collapsed = []
    for i, one in enumerate(split):
        gone = dropped[ends[i] - sizes[i] : ends[i]]
        collapsed.append(b" ".join([w for w, drop in zip(one, gone.tolist(), strict=True) if not drop] if gone.any() else one))
    runs = pa.StructArray.from_arrays([pa.array(start - (ends - sizes)[of]), pa.array(length), pa.array(period)], names=["start", "length", "period"])
    offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(split)))]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(sizes), pa.ListArray.from_arrays(offsets, runs), pa.array(collapsed, pa.binary())],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, split, total = [], [], 0
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            words = (text.as_py() or b"").split()  # bytes are split at ASCII white space
            if split and total + len(words) > CHUNK_WORDS:
                yield _chunk(ids, split)
                ids, split, total = [], [], 0
            ids.append(doc_id.as_py())
            split.append(words)
            total += len(words)
        if split:
            yield _chunk(ids, split)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs array<(start, length, period)>, collapsed) of every row of docs (doc_id, text, others ignored).

    Words are separated by ASCII white space and numbered from 0. A run is a stretch of words with smallest period q that
    holds at least 6 words and 4 periods and cannot be made longer; runs are listed by start and period. collapsed has the
    words that no run contains behind its first q words, joined by one space. A null, empty or blank text has no words
    and no runs. Rows with a null or repeated doc_id each get their own result; an empty table gives an empty one. A very
    long text takes memory in proportion to its length.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(
        _runs, "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary"
    ).withColumn("collapsed", F.col("collapsed").cast("string"))
