"""Few bins for many items: bin completion with branch and bound over a histogram.

Items of one size are interchangeable, so the search works on the count of each
size. A bin is built around the largest size left; the fillings of the rest of it
are enumerated by the space they waste, dominated ones left out, and the chosen
bin is repeated as often as the counts allow. The result is a list of bins with
how often each occurs, whose length is bounded by the sizes, not by the items.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping

import numpy as np

Bin = tuple[tuple[int, int], ...]  # (size, how many of it), descending


def lower_bound(counts: Mapping[int, int], capacity: int) -> int:
    """Bins that any packing needs (Martello and Toth's second bound)."""
    many = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        many[size] = n
    number = np.concatenate([[0], np.cumsum(many)])
    volume = np.concatenate([[0], np.cumsum(many * np.arange(capacity + 1))])
    middle = capacity // 2 + 1
    least = np.arange(capacity // 2 + 1)
    # Sizes above capacity - least lie alone; those down to the middle take one
    # bin each and leave room for the small ones of at least ``least``.
    edge = capacity - least + 1
    half, half_volume = number[edge] - number[middle], volume[edge] - volume[middle]
    small = volume[middle] - volume[least]
    over = np.maximum(small - (capacity * half - half_volume), 0)
    return int((number[-1] - number[middle] + -(-over // capacity)).max())


def best_fit(counts: Mapping[int, int], capacity: int) -> list[tuple[Bin, int]]:
    """Best fit in descending size: the first incumbent.

    Bins of equal filling are interchangeable too and are kept as one entry with
    a count, so equal sizes are placed together.
    """
    opened: dict[int, list[list]] = {}  # room left -> [bin, how many]
    rooms: list[int] = []  # ascending

    def add(room: int, bin_: dict, many: int) -> None:
        if room not in opened:
            opened[room] = []
            insort(rooms, room)
        opened[room].append([bin_, many])

    for size in sorted((s for s, n in counts.items() if n), reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                whole, rest = divmod(left, each)
                for each, many in ((each, whole), (rest, 1)):
                    if each and many:
                        add(capacity - each * size, {size: each}, many)
                break
            room = rooms[at]
            entry = opened[room][-1]
            each = min(room // size, left)
            many = min(entry[1], left // each)
            entry[1] -= many
            if not entry[1]:
                opened[room].pop()
                if not opened[room]:
                    del opened[room], rooms[at]
            add(room - each * size, {**entry[0], size: each}, many)
            left -= each * many
    return [(tuple(sorted(b.items(), reverse=True)), n) for entries in opened.values() for b, n in entries]


def _reachable(sizes: list[int], counts: Mapping[int, int], room: int) -> list[int]:
    """Bit sets: ``out[i]`` has the sums up to ``room`` of the first ``i`` sizes."""
    full, out = (1 << (room + 1)) - 1, [1]
    for size in sizes:
        bits, left, step = out[-1], min(counts[size], room // size), 1
        while left:
            take = min(step, left)
            bits |= (bits << (take * size)) & full
            left, step = left - take, step * 2
        out.append(bits)
    return out


def _fillings(sizes: list[int], counts: Mapping[int, int], sums: list[int], room: int) -> Iterator[Bin]:
    """Every filling of exactly ``room``, those with large sizes first."""

    def some(top: int, left: int) -> Iterator[tuple]:
        if not left:
            yield ()
            return
        for i in range(top, 0, -1):
            # What the first i sizes can not reach, fewer can not either.
            if not sums[i] >> left & 1:
                return
            size = sizes[i - 1]
            for many in range(min(counts[size], left // size), 0, -1):
                if sums[i - 1] >> (left - many * size) & 1:
                    for rest in some(i - 1, left - many * size):
                        yield ((size, many), *rest)

    yield from some(len(sizes), room)


def _dominated(filling: Bin, sizes: list[int], counts: Mapping[int, int], waste: int) -> bool:
    """Whether some items of the filling could give way to one spare item that
    needs their room and at most the waste besides. With the items moved to where
    that one was, no more bins are needed, so the filling need not be tried."""
    used = dict(filling)
    spare = [s for s in sizes if counts[s] > used.get(s, 0)]
    if not spare:
        return False
    items = [s for s, many in filling for _ in range(many)]
    sums = {0: 0}  # sum -> fewest items
    for item in items:
        for s, n in list(sums.items()):
            sums[s + item] = min(n + 1, sums.get(s + item, n + 1))
        if len(sums) > 512:
            break
    ordered = sorted(sums)
    at = 0
    for s in spare:
        # Sums within [s - waste, s]; one equal item in place of another is no gain.
        while at < len(ordered) and ordered[at] < s - waste:
            at += 1
        for i in range(at, len(ordered)):
            if ordered[i] > s:
                break
            if ordered[i] < s or sums[s] > 1:
                return True
    return False


def completions(counts: Mapping[int, int], capacity: int, width: int, most_waste: int) -> Iterator[tuple[int, Bin]]:
    """Up to ``width`` undominated bins around the largest size, by their waste."""
    largest = max(s for s, n in counts.items() if n)
    room = capacity - largest
    left = {s: n - (s == largest) for s, n in counts.items() if n and s <= room and n - (s == largest)}
    sizes = sorted(left)
    sums = _reachable(sizes, left, room)
    found = tried = 0
    for waste in range(min(room, most_waste) + 1):
        if not sums[-1] >> (room - waste) & 1:
            continue
        for filling in _fillings(sizes, left, sums, room - waste):
            tried += 1
            if not waste or not _dominated(filling, sizes, left, waste):
                both = dict(filling)
                both[largest] = both.get(largest, 0) + 1
                yield waste, tuple(sorted(both.items(), reverse=True))
                found += 1
            if found == width or tried == 8 * width:
                return


def pack(counts: Mapping[int, int], capacity: int, nodes: int = 6_000, width: int = 8) -> list[tuple[Bin, int]]:
    """Bins and how often each is used, for ``counts[size]`` items of each size.

    Depth first from the best-fit incumbent. A branch ends when its waste exceeds
    what a packing with one bin less than the incumbent may waste. ``nodes`` and
    ``width`` bound the search, never what is packed: when they are used up, the
    incumbent stands. Sizes lie between 1 and the capacity.
    """
    start = {s: n for s, n in counts.items() if n}
    if not start:
        return []
    if min(start) < 1 or max(start) > capacity:
        raise ValueError("a size is outside of 1 .. capacity")
    total = sum(s * n for s, n in start.items())
    least = lower_bound(start, capacity)
    best = best_fit(start, capacity)
    used = sum(n for _, n in best)
    if used == least:
        return best

    left, chosen, bins, wasted = dict(start), [], 0, 0

    def moves(spent: int) -> Iterator[tuple[int, Bin, int]]:
        allowed = (used - 1) * capacity - total - spent
        later = []
        for waste, bin_ in completions(left, capacity, width, allowed):
            most = min(left[s] // n for s, n in bin_)
            if waste:
                most = min(most, allowed // waste)
            if most:
                yield waste, bin_, most
                if most > 1:
                    later.append((waste, bin_, 1))
        yield from later

    # A stack instead of recursion: the depth may reach the number of sizes.
    stack, visited = [moves(0)], 0
    while stack and visited < nodes and used > least:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if chosen:
                waste, bin_, many = chosen.pop()
                bins, wasted = bins - many, wasted - waste * many
                for s, n in bin_:
                    left[s] = left.get(s, 0) + n * many
            continue
        visited += 1
        waste, bin_, many = step
        # The incumbent may have improved since the branch was made.
        if wasted + waste * many > (used - 1) * capacity - total:
            continue
        chosen.append(step)
        bins, wasted = bins + many, wasted + waste * many
        for s, n in bin_:
            left[s] -= n * many
            if not left[s]:
                del left[s]
        if not left:
            if bins < used:
                best, used = [(b, n) for _, b, n in chosen], bins
            stack.append(iter(()))
        else:
            stack.append(moves(wasted))
    return best
