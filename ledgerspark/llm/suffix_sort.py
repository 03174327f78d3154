"""External induced sorting: suffixes in order, with the lengths of their common prefixes.

Induced sorting orders all suffixes from the few that begin at a local minimum of the text (seeds). The strings between
seeds are named by their order, the string of names is sorted in turn, and two scans then derive all other suffixes: a
scan meets suffixes in order, and each one hands its predecessor in the text to a priority queue, as the tuple
(first symbol, place, position, common prefix). The first scan goes up and derives the suffixes that are greater than
their successor, the second goes down and derives the others. Two tuples with one first symbol share one symbol more
than their successors do, which is the minimum of the common prefixes scanned between these.

As a scan hands out tuples of one symbol in their final order, the queue keeps a run per symbol and moves runs to disk
when they outgrow its memory. A whole symbol is scanned at once, in numpy. Texts are many strings, each closed by a
separator of its own that no other symbol equals, so nothing is shared across strings.
"""

from __future__ import annotations

import os
import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

from ledgerspark.llm.periods import _common, _sort_suffixes

#: Bytes of waiting tuples that a queue holds in memory; more go to a file.
QUEUE_BYTES = 64 << 20
#: Symbols are a byte plus one; zero separates. Seven of them fill a word, short strings are filled with the mark.
_SYMBOLS, _BITS, _PER_WORD, _FILL = 257, 9, 7, 511
_TUPLE = np.dtype([("position", np.int32), ("common", np.uint8)])


class SymbolQueue:
    """Priority queue of tuples by first symbol, in order of arrival among those of one symbol; runs spill to disk.

    The file lies where Spark spills (SPARK_LOCAL_DIRS) and is gone when the queue is closed.
    """

    def __init__(self, memory: int | None = None) -> None:
        self.memory = QUEUE_BYTES if memory is None else memory
        self.held: dict[int, list[np.ndarray]] = defaultdict(list)
        self.spilled: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.size = 0
        self.file = None

    def __enter__(self) -> SymbolQueue:
        return self

    def __exit__(self, *_: object) -> None:
        if self.file is not None:
            self.file.close()

    def push(self, symbol: int, positions: np.ndarray, common: np.ndarray) -> None:
        run = np.empty(len(positions), _TUPLE)
        run["position"], run["common"] = positions, common
        self.held[symbol].append(run)
        self.size += run.nbytes
        if self.size > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
            self.file = tempfile.TemporaryFile(dir=folder if folder and os.path.isdir(folder) else None)
        self.file.seek(0, os.SEEK_END)
        for symbol, runs in self.held.items():
            at, run = self.file.tell(), np.concatenate(runs)
            self.file.write(run.tobytes())
            self.spilled[symbol].append((at, run.nbytes))
        self.held.clear()
        self.size = 0

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, common) of all that wait under symbol, which are then gone."""
        runs = []
        for at, size in self.spilled.pop(symbol, ()):
            self.file.seek(at)
            runs.append(np.frombuffer(self.file.read(size), _TUPLE))
        waiting = self.held.pop(symbol, [])
        self.size -= sum(r.nbytes for r in waiting)
        runs += waiting
        run = np.concatenate(runs) if runs else np.empty(0, _TUPLE)
        return run["position"].astype(np.int64), run["common"]


class _Minimum:
    """The minimum of values[a + 1 : b + 1] for many a < b."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(a):
            return np.empty(0, np.uint8)
        span = b - a
        level = np.frexp(span.astype(np.float64))[1] - 1  # the largest power of two that fits
        while len(self.levels) <= int(level.max()):
            step, top = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(top[:-step], top[step:]))
        result = np.empty(len(a), np.uint8)
        for k in np.unique(level).tolist():
            at = level == k
            table = self.levels[k]
            result[at] = np.minimum(table[a[at] + 1], table[b[at] + 1 - (1 << k)])
        return result


class SuffixSorter:
    """Suffixes of many byte strings. cap (at most 255) is the length from which common prefixes need not be told apart."""

    def __init__(self, strings: list[bytes], cap: int) -> None:
        self.cap = cap
        sizes = np.array([len(s) for s in strings], np.int64)
        closed = np.cumsum(sizes + 1)
        self.separators = closed - 1
        self.text = np.zeros(int(closed[-1]) if len(strings) else 0, np.int16)
        data = np.frombuffer(b"\0".join([*strings, b""]), np.uint8)
        self.text[:] = data
        self.text += 1
        self.text[self.separators] = 0
        n = len(self.text)
        change = np.flatnonzero(np.diff(self.text))  # last positions of runs of one symbol; separators never touch
        last = np.append(change, n - 1)
        run = np.diff(np.concatenate([[-1], last]))
        falls = np.append(self.text[change] > self.text[change + 1], False)
        self.falling = np.repeat(falls, run)  # greater than its successor
        ahead = np.repeat(last, run) - np.arange(n) + 1
        self.alike = np.minimum(ahead, cap).astype(np.uint8)  # how often the symbol stands from here on

    def _word(self, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Seven symbols from at on, up to and with stop."""
        word = np.zeros(len(at), np.uint64)
        for k in range(_PER_WORD):
            here = at + k
            symbol = np.where(here <= stop, self.text[np.minimum(here, len(self.text) - 1)], _FILL)
            word = (word << np.uint64(_BITS)) | symbol.astype(np.uint64)
        return word

    def _named(self, seeds: np.ndarray) -> np.ndarray:
        """Names of the strings from each seed to the next, in their order; separators come first, all different."""
        stop = np.append(seeds[1:], seeds[-1])
        at = self.text[seeds] == 0
        name = np.zeros(len(seeds), np.int64)
        name[at] = np.arange(int(at.sum()))
        order = np.flatnonzero(~at)
        group = np.zeros(len(order), np.int64)
        offset = 0
        open_ = np.arange(len(order))  # places in order that are not settled; equal groups are contiguous
        while len(open_):
            rows = order[open_]
            word = self._word(seeds[rows] + offset, stop[rows])
            by = np.argsort(word) if not offset else np.lexsort((word, group[open_]))
            order[open_], word = rows[by], word[by]
            old = group[open_]
            new = np.concatenate([[True], (np.diff(old) != 0) | (word[1:] != word[:-1])])
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(new)))
            group[open_] = open_[first][np.cumsum(new) - 1]
            offset += _PER_WORD
            rows = order[open_]
            more = seeds[rows] + offset <= stop[rows]  # a filled word settles its group
            open_ = open_[more & (np.repeat(size, size) > 1)]
        name[order] = group + int(at.sum())
        return name

    def _seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """(positions in order, common prefix with the one before) of the suffixes at local minima."""
        before = np.concatenate([[False], self.falling[:-1]])
        seeds = np.flatnonzero(~self.falling & before)
        names = self._named(seeds)
        order, ranks, _ = _sort_suffixes(names, np.full(len(seeds), len(seeds)))
        a, b = order[:-1], order[1:]
        low, high = np.minimum(a, b), np.maximum(a, b)
        same = _common(ranks, low, high, True)
        p, q = seeds[np.minimum(low + same, len(seeds) - 1)], seeds[np.minimum(high + same, len(seeds) - 1)]
        common = p - seeds[low]
        end = len(self.text) - 1
        open_ = np.flatnonzero(common < self.cap)
        while len(open_):
            x, y = p[open_], q[open_]
            differ = self._word(x, np.full(len(x), end)) ^ self._word(y, np.full(len(y), end))
            top = np.frexp((differ >> np.uint64(1)).astype(np.float64))[1]  # at most one too high by rounding up
            top = np.where((differ >> np.minimum(top + 1, 63).astype(np.uint64)) > 0, top + 1, top)
            top = np.where((top > 0) & ((differ >> np.maximum(top, 0).astype(np.uint64)) == 0), top - 1, top)
            shared = np.where(differ == 0, _PER_WORD, _PER_WORD - 1 - top // _BITS)
            common[open_] += shared
            p[open_] += shared
            q[open_] += shared
            open_ = open_[(shared == _PER_WORD) & (common[open_] < self.cap)]
        # nothing is shared from a separator on
        left = self.separators[np.searchsorted(self.separators, seeds)] - seeds
        common = np.minimum(np.minimum(common, self.cap), np.minimum(left[a], left[b]))
        return seeds[order], np.concatenate([[0], common]).astype(np.uint8)

    def _longer(self, common: np.ndarray) -> np.ndarray:
        return np.minimum(common.astype(np.int64) + 1, self.cap).astype(np.uint8)

    def _joined(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Parts of one symbol behind each other; across a joint, the shorter stretch of that symbol is shared."""
        parts = [p for p in parts if len(p[0])]
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.uint8)
        positions, common = np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])
        joint = np.cumsum([len(p) for p, _ in parts])[:-1]
        common[joint] = np.minimum(self.alike[positions[joint - 1]], self.alike[positions[joint]])
        common[0] = 0
        return positions, common

    def _derive(self, queue: SymbolQueue, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """All that waits under symbol, and what this derives under the same symbol in turn."""
        positions, common = queue.pop(symbol)
        parts = [(positions, common)]
        while len(positions):
            by = np.flatnonzero(self.text[np.maximum(positions - 1, 0)] == symbol)
            by = by[positions[by] > 0]
            if not len(by):
                break
            lowest = _Minimum(common)(by[:-1], by[1:])
            positions, common = positions[by] - 1, np.concatenate([[0], self._longer(lowest)]).astype(np.uint8)
            parts.append((positions, common))
        return self._joined(parts)

    def _hand_out(self, queue: SymbolQueue, positions: np.ndarray, common: np.ndarray, symbol: int, up: bool) -> None:
        """The predecessors of scanned suffixes go to the queue, as far as this scan derives them."""
        ahead = positions - 1
        before = self.text[np.maximum(ahead, 0)]
        by = np.flatnonzero((ahead >= 0) & ((before > symbol) if up else (before < symbol) & (before > 0)))
        if not len(by):
            return
        by = by[np.argsort(before[by], kind="stable")]
        symbols = before[by]
        lowest = np.zeros(len(by), np.uint8)
        inside = np.flatnonzero(symbols[1:] == symbols[:-1]) + 1
        lowest[inside] = _Minimum(common)(by[inside - 1], by[inside])
        lowest = self._longer(lowest)
        first = np.concatenate([[0], np.flatnonzero(np.diff(symbols)) + 1, [len(by)]])
        for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            queue.push(int(symbols[i]), ahead[by[i:j]], lowest[i:j])

    def scan(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, common prefix with the one before) by first symbol, from the greatest suffix down; no separators."""
        if not len(self.text):
            return
        seeds, shared = self._seeds()
        symbols = self.text[seeds]
        bounds = np.searchsorted(symbols, np.arange(_SYMBOLS + 1))
        with SymbolQueue() as rising, SymbolQueue() as falling, SymbolQueue() as derived:
            used = np.flatnonzero(np.bincount(self.text, minlength=_SYMBOLS)).tolist()
            for symbol in used:
                mine = slice(bounds[symbol], bounds[symbol + 1])
                positions, common = self._derive(rising, symbol)
                if len(positions):
                    derived.push(symbol, positions, common)
                self._hand_out(rising, *self._joined([(positions, common), (seeds[mine], shared[mine].copy())]), symbol, True)
            for symbol in reversed(used[1:]):
                positions, common = derived.pop(symbol)
                down = np.concatenate([[0], common[:0:-1]]).astype(np.uint8) if len(common) else common
                found = self._joined([self._derive(falling, symbol), (positions[::-1], down)])
                if len(found[0]):
                    yield found
                    self._hand_out(falling, *found, symbol, False)
