"""Elias-Fano sequences and an n-gram trie on them, for many look-ups at once."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np

_U = np.uint64


class EliasFano:
    """A monotone sequence of n integers below u in n (2 + log2(u/n)) bits.

    The low bits of each value lie side by side; the high bits are a unary bit
    vector. ``rank`` counts its ones before each word, so that the i-th one is
    found by a search for its word and six halvings inside.
    """

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, rank: np.ndarray):
        self.n, self.width, self.low, self.high, self.rank = n, width, low, high, rank

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        low = np.zeros(n * width // 64 + 2, np.uint64)
        if width:
            part = values & _U((1 << width) - 1)
            at = np.arange(n, dtype=np.uint64) * _U(width)
            word, off = (at >> _U(6)).astype(np.int64), at & _U(63)
            np.bitwise_or.at(low, word, part << off)
            over = off + _U(width) > _U(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (_U(64) - off[over]))
        ones = (values >> _U(width)) + np.arange(n, dtype=np.uint64)
        high = np.zeros((int(ones[-1]) >> 6) + 1 if n else 1, np.uint64)
        np.bitwise_or.at(high, (ones >> _U(6)).astype(np.int64), _U(1) << (ones & _U(63)))
        rank = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        return EliasFano(n, width, low, high, rank)

    def get(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.rank, i, "right") - 1
        left = (i - self.rank[word]).astype(np.uint64)
        bits, at = self.high[word], np.zeros(len(i), np.uint64)
        for half in (32, 16, 8, 4, 2, 1):
            below = np.bitwise_count((bits >> at) & _U((1 << half) - 1)).astype(np.uint64)
            up = left >= below
            left -= np.where(up, below, _U(0))
            at += np.where(up, _U(half), _U(0))
        high = (word.astype(np.uint64) << _U(6)) + at - i.astype(np.uint64)
        if not self.width:
            return high
        pos = i.astype(np.uint64) * _U(self.width)
        w, off = (pos >> _U(6)).astype(np.int64), pos & _U(63)
        low = self.low[w] >> off
        low |= np.where(off > 0, self.low[w + 1] << ((_U(64) - off) & _U(63)), _U(0))
        return (high << _U(self.width)) | (low & _U((1 << self.width) - 1))

    def successor(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Index of the first value >= x in [lo, hi), else hi."""
        x, lo, hi = x.astype(np.uint64), lo.astype(np.int64).copy(), hi.astype(np.int64).copy()
        todo = np.flatnonzero(lo < hi)
        while len(todo):
            mid = (lo[todo] + hi[todo]) >> 1
            less = self.get(mid) < x[todo]
            lo[todo[less]] = mid[less] + 1
            hi[todo[~less]] = mid[~less]
            todo = todo[lo[todo] < hi[todo]]
        return lo

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of x in the sequence, -1 if absent."""
        at = self.successor(x, np.zeros(len(x), np.int64), np.full(len(x), self.n))
        out = np.full(len(x), -1)
        inside = np.flatnonzero(at < self.n)
        hit = inside[self.get(at[inside]) == x[inside].astype(np.uint64)]
        out[hit] = at[hit]
        return out


class Trie:
    """Two levels: contexts, and the successors of each.

    Words are numbered by their hash. A successor is stored as context number
    times vocabulary plus word number, which is monotone over the whole level; it
    is searched for between its context's two pointers only. Values are codes
    into a table of at most 255 log-probabilities.
    """

    def __init__(self, levels: dict[str, EliasFano], codes: np.ndarray, table: np.ndarray):
        self.levels, self.codes, self.table = levels, codes, table

    @staticmethod
    def build(context: np.ndarray, word: np.ndarray, log_p: np.ndarray) -> Trie:
        """From distinct (context, word) pairs sorted by both."""
        names, first = np.unique(context, return_index=True)
        words = np.unique(word)
        owner = np.repeat(np.arange(len(names)), np.diff(np.append(first, len(context))))
        inner = owner.astype(np.uint64) * _U(max(len(words), 1)) + np.searchsorted(words, word).astype(np.uint64)
        # Bins of equal width, each known by its mean: no value is far off.
        low, high = (log_p.min(), log_p.max()) if len(log_p) else (0.0, 0.0)
        code = np.minimum((log_p - low) / max(high - low, 1e-9) * 255, 254).astype(np.uint8)
        total, count = np.bincount(code, log_p, 255), np.bincount(code, minlength=255)
        table = total[:255] / np.maximum(count[:255], 1)
        levels = {
            "contexts": EliasFano.of(names), "words": EliasFano.of(words),
            "pointers": EliasFano.of(np.append(first, len(context))), "successors": EliasFano.of(inner),
        }
        return Trie(levels, code, table)

    def codes_of(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Code of each pair, 255 where the context never had that successor."""
        ctx, back = np.unique(context, return_inverse=True)
        c = self.levels["contexts"].find(ctx)[back]
        known, back = np.unique(word, return_inverse=True)
        w = self.levels["words"].find(known)[back]
        out = np.full(len(context), 255, np.uint8)
        ok = np.flatnonzero((c >= 0) & (w >= 0))
        pointers, inner = self.levels["pointers"], self.levels["successors"]
        c, w = c[ok], w[ok]
        x = c.astype(np.uint64) * _U(self.levels["words"].n) + w.astype(np.uint64)
        hi = pointers.get(c + 1).astype(np.int64)
        at = inner.successor(x, pointers.get(c).astype(np.int64), hi)
        some = np.flatnonzero(at < hi)
        hit = some[inner.get(at[some]) == x[some]]
        out[ok[hit]] = self.codes[at[hit]]
        return out

    @contextmanager
    def mapped(self) -> Iterator[Trie]:
        """The same trie read from a memory-mapped file of this task."""
        with tempfile.TemporaryDirectory() as folder:
            path, spots, size = os.path.join(folder, "trie"), [], 0
            arrays = [a for ef in self.levels.values() for a in (ef.low, ef.high, ef.rank)]
            with open(path, "wb") as out:
                for a in [*arrays, self.codes]:
                    pad = -size % 8
                    out.write(b"\0" * pad + a.tobytes())
                    spots.append(size + pad)
                    size += pad + a.nbytes

            def view(i: int, a: np.ndarray) -> np.ndarray:
                return np.memmap(path, a.dtype, "r", spots[i], a.shape) if a.size else a

            levels = {}
            for k, (name, ef) in enumerate(self.levels.items()):
                levels[name] = EliasFano(ef.n, ef.width, *[view(3 * k + j, a) for j, a in enumerate((ef.low, ef.high, ef.rank))])
            yield Trie(levels, view(len(arrays), self.codes), self.table)
