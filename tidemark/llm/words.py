"""Words of many texts at once, as arrays of byte positions and 64-bit hashes.

All word patterns of this package cut at ASCII characters only, so they can be
applied to the bytes of UTF-8 text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text looked at together; each takes some 50 bytes of scratch memory.
SLICE_BYTES = 2_000_000


def _table(separators: list[int]) -> np.ndarray:
    keep = np.ones(256, bool)
    keep[separators] = False
    return keep


# `[^\x20\x09-\x0D]+`
BLANK_SEPARATED = _table([0x20, *range(0x09, 0x0E)])
# `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, where A-Z is lower-cased first
LETTERS_DIGITS = _table(
    [b for b in range(0x80) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)]
)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def buffers(texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and ``n + 1`` offsets of an Arrow string column; NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data else np.empty(0, np.uint8)
    return raw, offs - offs[0]


def slices(table, column: str = "text") -> Iterator:
    """Runs of whole rows of about ``SLICE_BYTES``; a longer text comes alone."""
    length = pc.fill_null(pc.binary_length(table.column(column)), 0)
    size = np.cumsum(np.asarray(length, np.int64))
    at = 0
    while at < table.num_rows:
        base = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, base + SLICE_BYTES, "right")))
        yield table.slice(at, end - at)
        at = end


class Words:
    """Words of a column of texts.

    ``start``, ``end``: byte positions in ``raw``; ``doc``: row of the word;
    ``first``: ``n + 1`` offsets of the rows' words; ``hash``: 64 bits.
    """

    def __init__(self, texts, keep: np.ndarray, lower: bool = True):
        raw, offs = buffers(texts)
        self.raw, self.offs = raw, offs
        n = len(raw)
        inside = keep[raw]
        edge = np.zeros(n + 1, bool)
        edge[offs] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        before &= ~edge[:-1]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        after &= ~edge[1:]
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offs)
        self.doc = np.repeat(np.arange(len(offs) - 1), np.diff(self.first))
        self.hash = self._hash(LOWER[raw] if lower else raw, inside)

    def _hash(self, raw: np.ndarray, inside: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.empty(0, np.uint64)
        length = self.end - self.start
        power = np.full(int(length.max()), _STEP, np.uint64)
        power[0] = 1
        power = np.cumprod(power)
        at = np.flatnonzero(inside)
        begin = np.cumsum(length) - length
        value = _VALUE[raw[at]] * power[np.arange(len(at)) - np.repeat(begin, length)]
        return mix(np.add.reduceat(value, begin) + length.astype(np.uint64))


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``width`` words; a row with fewer words, but
    not none, has its whole sequence as one."""
    count = np.diff(words.first)
    h = words.hash
    last = max(len(h) - width + 1, 0)
    out = np.zeros(last, np.uint64)
    for k in range(width):
        out = mix(out * _STEP + h[k : k + last])
    whole = words.doc[:last] == words.doc[width - 1 : width - 1 + last]
    rows = words.doc[:last][whole]
    out = out[whole]
    few = np.flatnonzero((count > 0) & (count < width))
    extra = []
    for r in few:
        x = np.zeros(1, np.uint64)
        for v in h[words.first[r] : words.first[r + 1]]:
            x = mix(x * _STEP + v)
        extra.append(mix(x + np.uint64(count[r]))[0])
    if extra:
        out = np.concatenate([out, np.array(extra, np.uint64)])
        rows = np.concatenate([rows, few])
    return out, rows
