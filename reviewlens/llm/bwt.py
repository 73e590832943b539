"""A collection's Burrows-Wheeler transform and common prefixes, built column by column.

Each round puts one more symbol in front of every string of the collection and inserts the
suffixes so lengthened into the sorted order of all suffixes met so far. The order itself is
never stored: there are the symbols before the suffixes (the transform) and the lengths that
neighbours have in common, two files that each round reads in sequence, ``BLOCK`` symbols at a time, and
writes anew with the round's insertions. A round keeps a few numbers for each string and for each symbol.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np

END = 255  # before a whole string; no byte of UTF-8
BLOCK = 1 << 19  # symbols that a round holds at once
FAR = 255  # more than any common prefix
NUMBERS = np.arange(BLOCK, dtype=np.int32)


class _Files:
    """The symbols and the common prefixes, in a task's own scratch that is gone with the task."""

    def __init__(self, stack: ExitStack):
        self.symbols, self.common = (stack.enter_context(tempfile.TemporaryFile(buffering=0)) for _ in range(2))
        self.n = 0

    def clear(self) -> None:
        self.n = 0
        for file in (self.symbols, self.common):
            file.seek(0)

    def append(self, symbols: np.ndarray, common: np.ndarray) -> None:
        self.symbols.write(np.ascontiguousarray(symbols, np.uint8))
        self.common.write(np.ascontiguousarray(common, np.uint8))
        self.n += len(symbols)

    def blocks(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """First place, symbols and common prefixes of each block in turn."""
        for file in (self.symbols, self.common):
            file.seek(0)
        for first in range(0, self.n, BLOCK):
            size = min(BLOCK, self.n - first)
            parts = []
            for file in (self.symbols, self.common):
                part = np.empty(size, np.uint8)
                file.readinto(part)
                parts.append(part)
            yield first, *parts

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        parts = [(s, c) for _, s, c in self.blocks()]
        return tuple(np.concatenate(x) if x else np.zeros(0, np.uint8) for x in zip(*parts))


def _least(common: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least value of ``common`` in each range; ranges come in descending order, so that what
    lies between two of them is not read."""
    bounds = np.empty(2 * len(first), np.int64)
    bounds[::2], bounds[1::2] = first, last + 1
    return np.minimum.reduceat(common, bounds)[::2] if len(first) else common[:0]


def _places(files: _Files, below: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the suffixes at the ascending places ``where``, lengthened by the symbols there: their rank among
    all suffixes so lengthened, and what they have in common with the one before and the one after, without
    the new symbol; ``FAR`` if that one begins with another symbol. ``below`` counts the smaller symbols.
    """
    rank, before, after = np.empty(len(where), np.int64), np.full(len(where), FAR, np.uint8), np.full(len(where), FAR, np.uint8)
    seen = np.zeros(256, np.int64)  # of each symbol, in the blocks before
    since = np.full(256, FAR, np.uint8)  # the least common prefix since its last one
    waiting, so_far = np.full(256, -1), np.full(256, FAR, np.uint8)  # suffixes whose next one of their symbol has not come
    for first, symbols, common in files.blocks():
        a, b = np.searchsorted(where, (first, first + len(symbols)))
        mine, here = np.arange(a, b), where[a:b] - first
        counts = np.bincount(symbols, minlength=256)
        starts = np.cumsum(counts) - counts
        by_symbol = np.argsort(symbols, kind="stable")
        inverse = np.empty(len(symbols), np.int32)
        inverse[by_symbol] = NUMBERS[: len(symbols)]
        own, at = symbols[here], inverse[here]
        rank[a:b] = below[own] + seen[own] + at - starts[own]
        down = np.arange(len(here))[::-1]
        padded = np.append(common, np.uint8(FAR))
        first_here, last_here = at == starts[own], at == starts[own] + counts[own] - 1
        pick = down[~first_here[down]]
        before[mine[pick]] = _least(padded, by_symbol[at[pick] - 1] + 1, here[pick])
        pick = down[~last_here[down]]
        after[mine[pick]] = _least(padded, here[pick] + 1, by_symbol[at[pick] + 1])
        if len(symbols) == files.n:
            break

        # what goes on over the edges of blocks; those that wait for a symbol of this block have it
        present = np.flatnonzero(counts)
        least_to = np.minimum.accumulate(common)
        least_from = np.append(np.minimum.accumulate(common[::-1])[::-1], np.uint8(FAR))
        came = present[waiting[present] >= 0]
        after[waiting[came]] = np.minimum(so_far[came], least_to[by_symbol[starts[came]]])
        waiting[came] = -1
        so_far = np.minimum(so_far, least_to[-1])
        lone = first_here & (seen[own] > 0)
        before[mine[lone]] = np.minimum(since[own[lone]], least_to[here[lone]])
        waiting[own[last_here]] = mine[last_here]
        so_far[own[last_here]] = least_from[here[last_here] + 1]
        since = np.minimum(since, least_to[-1])
        since[present] = least_from[by_symbol[starts[present] + counts[present] - 1] + 1]
        seen += counts
    return rank, before, after


def _insert(old: _Files, new: _Files, spots: np.ndarray, symbols: np.ndarray, common: np.ndarray, after: np.ndarray) -> None:
    """Write ``new``: ``old`` with the values that belong at the ascending places ``spots``; ``after``, where
    it is not ``FAR``, becomes the common prefix of what follows."""
    new.clear()
    place = spots - np.arange(len(spots))  # how much of the old file comes before each
    held = FAR  # for the first value of the next block
    for first, own_symbols, own_common in old.blocks():
        last = first + len(own_symbols)
        a, b = np.searchsorted(place, (first, last if last < old.n else old.n + 1))
        fresh = place[a:b] - first + np.arange(b - a)
        stays = np.ones(len(own_symbols) + b - a, bool)
        stays[fresh] = False
        grown_symbols, grown_common = np.empty(len(stays), np.uint8), np.empty(len(stays), np.uint8)
        grown_symbols[stays], grown_symbols[fresh] = own_symbols, symbols[a:b]
        grown_common[stays], grown_common[fresh] = own_common, common[a:b]
        if held != FAR:
            grown_common[0] = held
        follows = fresh + 1
        told = after[a:b] != FAR
        inside = told & (follows < len(grown_common))
        grown_common[follows[inside]] = after[a:b][inside]
        beyond = after[a:b][told & ~inside]
        held = int(beyond[0]) if len(beyond) else FAR
        new.append(grown_symbols, grown_common)


def transform(strings: list[bytes], most: int) -> tuple[np.ndarray, np.ndarray]:
    """The transform, and each suffix's common prefix with the one before it, ``most`` at most.

    The strings' ends sort before all symbols, in the strings' order. No string may be empty, and
    ``most`` is under 255.
    """
    m = len(strings)
    data = np.frombuffer(b"".join(strings), np.uint8)
    starts = np.cumsum([0] + [len(s) for s in strings[:-1]])
    place = starts + np.array([len(s) for s in strings]) - 1  # of each string's newest symbol
    with ExitStack() as stack:
        old, new = _Files(stack), _Files(stack)
        for first in range(0, m, BLOCK):
            old.append(data[place[first : first + BLOCK]], np.zeros(len(place[first : first + BLOCK]), np.uint8))
        counts, where = np.bincount(data[place], minlength=256), np.arange(m)
        while len(where):
            order = np.argsort(where)
            where, place, starts = where[order], place[order], starts[order]
            rank, before, after = _places(old, np.cumsum(counts) - counts, where)
            order = np.argsort(rank)
            rank, before, after, place, starts = rank[order], before[order], after[order], place[order] - 1, starts[order]
            shared = np.where(before == FAR, 0, np.minimum(before, most - 1) + 1).astype(np.uint8)
            shared_after = np.where(after == FAR, FAR, np.minimum(after, most - 1) + 1).astype(np.uint8)
            inside = place >= starts
            symbols = np.where(inside, data[place], END).astype(np.uint8)
            spots = m + rank
            _insert(old, new, spots, symbols, shared, shared_after)
            counts = counts + np.bincount(symbols, minlength=256)
            where, place, starts = spots[inside], place[inside], starts[inside]
            old, new = new, old
        return old.whole()


def repeated(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, which of its substrings of ``length`` starts anywhere else as well, by start.

    Walks every string from its end through the transform, which gives each suffix's place in
    the order; a suffix repeats if it shares ``length`` symbols with a neighbour there.
    """
    symbols, common = transform(strings, length)
    step = np.empty(len(symbols), np.int64)
    step[np.argsort(symbols, kind="stable")] = len(strings) + np.arange(len(symbols))
    shares = np.append(common >= length, False)
    shares = shares[:-1] | shares[1:]
    sizes = np.array([len(s) for s in strings])
    out = [np.zeros(max(0, n - length + 1), bool) for n in sizes]
    flat = np.zeros(int(np.maximum(0, sizes - length + 1).sum()), bool)
    ends = np.cumsum(np.maximum(0, sizes - length + 1))
    where, live = np.arange(len(strings)), np.arange(len(strings))
    for n in range(1, int(sizes.max(initial=0)) + 1):
        where = step[where]
        if n >= length:
            flat[ends[live] - 1 - (n - length)] = shares[where]
        more = sizes[live] > n
        where, live = where[more], live[more]
    return np.split(flat, ends[:-1]) if len(out) else out
