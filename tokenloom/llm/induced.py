"""Suffix arrays with common-prefix values by external induced sorting.

The text is a row of segments, each ended by the symbol 0; these ends differ from each other and stand in text order, so
no common prefix reaches over one. Suffixes are of type S where the next different symbol is larger, else of type L.

1. The substrings between neighbouring leftmost S suffixes are named in order. The names are a shorter text of the same
   form, sorted in memory where it fits and by the same induction, recursively, where it does not.
2. From the sorted leftmost S suffixes the L suffixes are induced in rising order, and from those the S suffixes in
   falling order: a suffix taken from the queue puts the one before it into the queue under that one's first symbol.
   Queues are first in, first out per symbol, which makes them priority queues for suffixes; beyond the memory limit
   they live on disk. Each entry carries its common prefix with the entry put in before it: one more than the least
   common prefix on the way from that entry's origin to its own.

Whole runs of suffixes are taken at a time as numpy arrays.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Bytes of a sort's queues and names, of what a task has beside a heap on its executor.
MEMORY = 96 << 20
PIECE = 1 << 16
_BIG = np.int32(1 << 30)


class Budget:
    """Bytes that all queues of one sort may hold in memory."""

    def __init__(self, limit: int) -> None:
        self.limit, self.used = limit, 0


class Queue:
    """Suffixes of one first symbol with their common prefixes, first in, first out; spills to a file of the task."""

    def __init__(self, budget: Budget, kind: type = np.int64) -> None:
        self.budget, self.kind = budget, np.dtype(kind)
        self.parts: list[np.ndarray] = []
        self.file = None
        self.sizes: list[int] = []

    def put(self, place: np.ndarray, shared: np.ndarray) -> None:
        part = np.stack([place.astype(self.kind), shared.astype(self.kind)])
        self.parts.append(part)
        self.budget.used += part.nbytes
        if self.budget.used > self.budget.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile(prefix="suffixes-")
        self.file.seek(0, 2)
        for part in self.parts:
            self.file.write(part.tobytes())
            self.sizes.append(part.shape[1])
            self.budget.used -= part.nbytes
        self.parts = []

    def take(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All entries in order, about ``PIECE`` at a time; the queue is empty at once and may be filled meanwhile."""
        sizes, self.sizes, file, self.file = self.sizes, [], self.file, None
        parts, self.parts = self.parts, []
        self.budget.used -= sum(p.nbytes for p in parts)

        def each() -> Iterator[np.ndarray]:
            if file is not None:
                file.seek(0)
                for n in sizes:
                    yield np.frombuffer(file.read(2 * self.kind.itemsize * n), self.kind).reshape(2, n)
                file.close()
            yield from parts

        held, n = [], 0
        for part in each():
            held.append(part)
            n += part.shape[1]
            if n >= PIECE:
                whole = np.concatenate(held, axis=1)
                yield whole[0], whole[1].astype(np.int32)
                held, n = [], 0
        if held:
            whole = np.concatenate(held, axis=1)
            yield whole[0], whole[1].astype(np.int32)

    def __bool__(self) -> bool:
        return bool(self.parts or self.sizes)


class _Minima:
    """Least value of any range of a short array."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        width = 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2
        self.flat = np.concatenate(self.levels)
        self.start = np.cumsum([0, *[len(x) for x in self.levels[:-1]]])

    def between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Inclusive bounds; an empty range gives a value above all."""
        size = high - low + 1
        k = np.maximum(np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1, 0)
        low_ = np.minimum(low, len(self.levels[0]) - 1)
        got = np.minimum(self.flat[self.start[k] + low_], self.flat[self.start[k] + np.maximum(high - (1 << k) + 1, 0)])
        return np.where(size > 0, got, _BIG)


def _runs(text: np.ndarray) -> np.ndarray:
    """How often each symbol repeats from its place on."""
    n, kind = len(text), place_kind(text)
    ends = np.flatnonzero(np.r_[text[1:] != text[:-1], True]).astype(kind)
    size = np.diff(ends, prepend=kind(-1))
    return np.repeat(ends, size) - np.arange(n, dtype=kind) + kind(1)


def place_kind(text: np.ndarray) -> type:
    """Whole numbers that places of the text need."""
    return np.int32 if len(text) < (1 << 31) - 2 else np.int64


def _types(text: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """True for S. Ends are S; they never run on, since no segment is empty."""
    after = np.arange(len(text), dtype=runs.dtype) + runs
    follow = np.where(after < len(text), text[np.minimum(after, len(text) - 1)], text.dtype.type(-1))
    return (follow > text) | (text == 0)


def _scan(text, runs, seeds, seed_shared, symbols, rising: bool, want: bool, budget: Budget):
    """One pass. ``seeds`` holds for each symbol the suffixes that are known, in the order of the pass.

    Returns for each symbol the induced suffixes and their common prefixes, both as lists of arrays in pass order.
    """
    queues: dict[int, Queue] = {}
    out: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    since = np.zeros(int(symbols.max()) + 1, np.int32) if want else None

    def push(place: np.ndarray, shared: np.ndarray, symbol: int, own: bool) -> None:
        for first in range(0, len(place), PIECE):
            p, s = place[first : first + PIECE], shared[first : first + PIECE]
            before = np.where(p > 0, text[p - 1], 0)
            good = (before >= symbol if own else before > symbol) if rising else ((before <= symbol if own else before < symbol) & (before > 0))
            good &= p > 0
            at = np.flatnonzero(good)
            if want:
                minima = _Minima(s)
            if not len(at):
                if want:
                    np.minimum(since, s.min(), out=since)
                continue
            d = before[at]
            order = np.argsort(d, kind="stable")
            at, d = at[order], d[order]
            head = np.r_[True, d[1:] != d[:-1]]
            heads = np.flatnonzero(head)
            if want:
                low = np.where(head, 0, np.r_[0, at[:-1] + 1])
                got = minima.between(low, at)
                got[heads] = np.minimum(got[heads], since[d[heads]])
                last = at[np.r_[heads[1:], len(at)] - 1]
                np.minimum(since, s.min(), out=since)
                since[d[heads]] = minima.between(last + 1, np.full(len(last), len(s) - 1))
                got = got + 1
            else:
                got = np.zeros(len(at), np.int32)
            bounds = np.r_[heads, len(at)]
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                queues.setdefault(int(d[a]), Queue(budget, place_kind(text))).put(p[at[a:b]] - 1, got[a:b])

    for symbol in symbols.tolist() if rising else symbols[::-1].tolist():
        last = None
        while (queue := queues.get(symbol)) is not None and queue:
            for place, shared in queue.take():
                if last is None:
                    shared = shared.copy()
                    shared[0] = 0
                last = int(place[-1])
                out.setdefault(symbol, []).append((place, shared))
                push(place, shared, symbol, True)
        queues.pop(symbol, None)
        place = seeds.get(symbol)
        if place is not None and len(place):
            shared = seed_shared[symbol].copy() if want else np.zeros(len(place), np.int32)
            shared[0] = 0 if last is None else min(int(runs[last]), int(runs[place[0]]))
            push(place, shared, symbol, False)
    return out


def _split(place: np.ndarray, shared: np.ndarray | None, text: np.ndarray):
    """By first symbol; the places are in suffix order."""
    if not len(place):
        return {}, {}
    first = text[place]
    bounds = np.r_[np.flatnonzero(np.r_[True, first[1:] != first[:-1]]), len(place)]
    seeds, values = {}, {}
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        seeds[int(first[a])] = place[a:b]
        if shared is not None:
            values[int(first[a])] = shared[a:b]
    return seeds, values


def _words(text: np.ndarray, place: np.ndarray, step: int, bits: int, per: int, size: np.ndarray) -> np.ndarray:
    """``per`` symbols from ``step * per`` on in one integer; beyond ``size`` symbols a pad above all symbols."""
    pad = (1 << bits) - 1
    word = np.zeros(len(place), np.int64)
    for i in range(step * per, step * per + per):
        symbol = text[np.minimum(place + i, len(text) - 1)].astype(np.int64)
        word = (word << bits) | np.where(i < size, symbol, pad)
    return word


def _names(text: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Rank of the substring from each mark to the next one, both included; a longer one stands before its prefix."""
    size = np.r_[np.diff(marks), 0] + 1
    bits = int(int(text.max()) + 1).bit_length()
    per = max(1, 62 // bits)
    rank = np.zeros(len(marks), np.int64)
    open_ = np.arange(len(marks))
    step, tail = 0, []
    while len(open_):
        word = _words(text, marks[open_], step, bits, per, size[open_])
        tail.append((open_, np.unique(word, return_inverse=True)[1]))
        step += 1
        open_ = open_[size[open_] > step * per]
    most = len(marks) + 1
    for where, own in reversed(tail):
        # what follows a word counts after it; without a rest the substring is a prefix and stands behind
        rank[where] = np.unique(own.astype(np.int64) * (most + 1) + np.where(rank[where] > 0, rank[where], most), return_inverse=True)[1] + 1
    rank[text[marks] == 0] = 0
    return rank


def _doubling(names: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a text that fits in memory."""
    n = len(names)
    ends = names == 0
    rank = np.where(ends, 0, names + int(ends.sum()))
    rank[ends] = np.arange(int(ends.sum()))
    width = 1
    while True:
        follow = rank[np.minimum(np.arange(n) + width, n - 1)]
        key = rank * (int(rank.max()) + 1) + follow
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.r_[False, key[order][1:] != key[order][:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        width *= 2


def _shared(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the one before it in the order, up to the nearer segment end."""
    n = len(text)
    ends = np.flatnonzero(text == 0)
    left = ends[np.searchsorted(ends, order)] - order
    limit = np.r_[0, np.minimum(left[1:], left[:-1])]
    got = np.zeros(len(order), np.int64)
    a, b = order, np.r_[order[:1], order[:-1]]
    live = np.flatnonzero(limit > 0)
    bits = int(int(text.max()) + 1).bit_length()
    per = max(1, 62 // bits)
    while len(live):
        full = np.full(len(live), per + 1)
        x = _words(text, a[live] + got[live], 0, bits, per, full) ^ _words(text, b[live] + got[live], 0, bits, per, full)
        same = np.zeros(len(live), np.int64)
        for i in range(per):
            same += (x >> (bits * (per - 1 - i))) == 0
        got[live] += same
        live = live[(same == per) & (got[live] < limit[live])]
    return np.minimum(got, limit).astype(np.int32)


def suffix_array(text: np.ndarray, memory: int = MEMORY, want: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Places of all suffixes in order, and the common prefix of each with its predecessor.

    ``text`` holds whole numbers, its last one 0; no segment may be empty. The suffixes that begin with 0 are left out.
    Where the names of the substrings take more than ``memory`` bytes to sort they are sorted by recursion.
    """
    if len(text) <= 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    text = text.astype(np.int64) if text.dtype.kind != "i" else text
    runs = _runs(text)
    kind = _types(text, runs)
    marks = np.flatnonzero(kind & np.r_[False, ~kind[:-1]]).astype(place_kind(text))
    del kind
    names = _names(text, marks)
    if len(np.unique(names[names > 0])) == int((names > 0).sum()):
        order = np.argsort(names, kind="stable")
    elif 48 * len(names) <= memory:
        order = _doubling(names)
    else:
        order, _ = suffix_array(names, memory, want=False)
        order = np.concatenate([np.flatnonzero(names == 0), order])
    marks = marks[order]
    del names, order
    shared = _shared(text, marks) if want else None
    symbols = np.unique(text)
    budget = Budget(memory)
    seeds, values = _split(marks, shared, text)
    low = _scan(text, runs, seeds, values, symbols, True, want, budget)
    seeds, values = {}, {}
    flat: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for symbol, parts in low.items():
        place, common = np.concatenate([p for p, _ in parts]), np.concatenate([s for _, s in parts])
        flat[symbol] = place, common
        seeds[symbol] = place[::-1]
        values[symbol] = np.r_[np.int32(0), common[::-1][:-1]].astype(np.int32)
    del low
    high = _scan(text, runs, seeds, values, symbols[symbols > 0], False, want, budget)
    places, commons = [], []
    for symbol in symbols[symbols > 0].tolist():
        last = None
        if symbol in flat:
            places.append(flat[symbol][0])
            commons.append(flat[symbol][1])
            last = int(flat[symbol][0][-1])
        if symbol in high:
            place = np.concatenate([p for p, _ in high[symbol]])[::-1]
            common = np.concatenate([s for _, s in high[symbol]])[::-1]
            common = np.r_[np.int32(0 if last is None else min(int(runs[last]), int(runs[place[0]]))), common[:-1]].astype(np.int32)
            places.append(place)
            commons.append(common)
    return np.concatenate(places), np.concatenate(commons)
