"""Merging sorted runs of strings without comparing a known prefix again."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def front_code(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix with the row before, and the bytes after it, of a sorted
    matrix of equally long rows."""
    if not len(rows):
        return np.empty(0, np.uint8), np.empty(0, np.uint8)
    other = rows[1:] != rows[:-1]
    shared = np.where(other.any(1), other.argmax(1), rows.shape[1])
    shared = np.append(0, shared).astype(np.uint8)
    return shared, rows[np.arange(rows.shape[1]) >= shared[:, None]]


def decode(shared: np.ndarray, rest: np.ndarray, width: int) -> list[bytes]:
    out, at, last, tail = [], 0, b"", rest.tobytes()
    for n in shared.tolist():
        end = at + width - n
        last = last[:n] + tail[at:end]
        out.append(last)
        at = end
    return out


def merge_order(runs: list[list[bytes]]) -> np.ndarray:
    """The order of all strings of sorted runs, as places in the runs one after the
    other; equal ones as in these. Python's sort finds the runs and merges them
    without a step of Python per string. :func:`merge` gives the same order one by
    one."""
    strings = [x for run in runs for x in run]
    return np.array(sorted(range(len(strings)), key=strings.__getitem__), np.int64)


def shared_prefixes(rows: np.ndarray) -> np.ndarray:
    """Common prefix of each row of a matrix with the row before; -1 for the first."""
    out = np.full(len(rows), -1, np.int64)
    # Blocks of rows stay small in memory.
    for a in range(1, len(rows), 1 << 16):
        other = rows[a : a + (1 << 16)] != rows[a - 1 : min(a + (1 << 16), len(rows)) - 1]
        out[a : a + (1 << 16)] = np.where(other.any(1), other.argmax(1), rows.shape[1])
    return out


def _differ(a: bytes, b: bytes, at: int, width: int) -> int:
    """First difference at or after ``at``, before which both are alike."""
    while at + 8 <= width and a[at : at + 8] == b[at : at + 8]:
        at += 8
    while at < width and a[at] == b[at]:
        at += 1
    return at


def merge(runs: list[tuple[list[bytes], list[int]]], width: int) -> Iterator[tuple[bytes, int, int, int]]:
    """(string, prefix shared with the string before, run, place in the run) in
    order. Each run is sorted and comes with its neighbours' common prefixes.

    A tree of losers in which every entry carries the prefix it shares with the
    winner it lost to. Of two entries the one sharing more with the last string
    is the smaller; only on a tie are characters compared, from there on.
    """
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    place = [0] * leaves
    head: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (leaves - len(runs))
    loser, known = [0] * leaves, [0] * leaves

    def play(w: int, h: int, node: int) -> tuple[int, int]:
        """The winner at ``node`` and the prefix it shares with the last string."""
        other = loser[node]
        a, b, g = head[w], head[other], known[node]
        if b is None or (a is not None and h > g):
            return w, h
        if a is None or h < g:
            loser[node], known[node] = w, h
            return other, g
        d = _differ(a, b, h, width)
        if d == width or a[d] < b[d]:
            known[node] = d
            return w, h
        loser[node], known[node] = w, d
        return other, g

    winners = list(range(leaves))
    first = leaves // 2
    while first:  # the first round, level by level
        out = []
        for k in range(first):
            loser[first + k], known[first + k] = winners[2 * k + 1], 0
            out.append(play(winners[2 * k], 0, first + k)[0])
        winners, first = out, first // 2
    # A run that is through shares less than nothing.
    known = [-1 if head[x] is None else g for x, g in zip(loser, known, strict=True)]
    w, h = winners[0], 0
    a = head[w]
    while a is not None:
        yield a, h, w, place[w]
        place[w] += 1
        strings, shared = runs[w]
        if place[w] < len(strings):
            a, h = strings[place[w]], shared[place[w]]
        else:
            a, h = None, -1
        head[w] = a
        node = (w + leaves) >> 1
        while node:
            g = known[node]
            if h < g:
                other = loser[node]
                loser[node], known[node] = w, h
                w, a, h = other, head[other], g
            elif h == g >= 0:
                other = loser[node]
                b = head[other]
                d = _differ(a, b, h, width)
                if d == width or a[d] < b[d]:
                    known[node] = d
                else:
                    loser[node], known[node] = w, d
                    w, a = other, b
            node >>= 1
