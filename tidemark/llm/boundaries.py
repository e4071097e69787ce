"""Fill-in-middle cuts found in Roaring-style sets of token boundaries."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

# Positions with equal high bits share a container.
SPAN = 1 << 16
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class ArrayContainer:
    """Few positions: the sorted list itself."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, rank: int) -> int:
        return int(self.low[rank])


class BitmapContainer:
    """Many scattered positions: one bit each, with the ones before each 64-byte block."""

    BLOCK = 64

    def __init__(self, low: np.ndarray):
        bits = np.zeros(SPAN, bool)
        bits[low] = True
        self.bytes = np.packbits(bits, bitorder="little")
        per_block = _ONES[self.bytes].reshape(-1, self.BLOCK).sum(axis=1, dtype=np.int64)
        self.before = np.concatenate([[0], np.cumsum(per_block)])

    def select(self, rank: int) -> int:
        block = int(np.searchsorted(self.before, rank, "right")) - 1
        inside = np.unpackbits(self.bytes[block * self.BLOCK : (block + 1) * self.BLOCK], bitorder="little")
        at = np.flatnonzero(inside)[rank - int(self.before[block])]
        return block * self.BLOCK * 8 + int(at)


class RunContainer:
    """Stretches of consecutive positions: their starts and the positions before each."""

    def __init__(self, starts: np.ndarray, before: np.ndarray):
        self.starts, self.before = starts.astype(np.uint16), before.astype(np.int64)

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.before, rank, "right")) - 1
        return int(self.starts[run]) + rank - int(self.before[run])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest form of sorted, distinct positions below ``SPAN``."""
    first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    array, bitmap, runs = 2 * len(low), SPAN // 8, 4 * len(first)
    if runs < min(array, bitmap):
        return RunContainer(low[first], first)
    return ArrayContainer(low) if array <= bitmap else BitmapContainer(low)


class BoundarySet:
    """Ascending positions in containers, found by rank.

    ``before[i]`` is the number of positions ahead of container ``i``; a binary
    search over it finds the container, which selects within itself.
    """

    def __init__(self):
        self.high: list[int] = []
        self.containers: list = []
        self.before: list[int] = [0]

    def add(self, high: int, low: np.ndarray) -> None:
        """Positions ``high * SPAN + low``, above all that were added before."""
        if len(low):
            self.high.append(high)
            self.containers.append(container(low))
            self.before.append(self.before[-1] + len(low))

    def __len__(self) -> int:
        return self.before[-1]

    def select(self, rank: int) -> int:
        """The position with ``rank`` smaller ones."""
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        at = bisect_right(self.before, rank) - 1
        return self.high[at] * SPAN + self.containers[at].select(rank - self.before[at])


def boundaries(text: str) -> BoundarySet:
    """Where the tokens ``[A-Za-z]+|[^A-Za-z]`` of a text start, and its end, in
    code points. One container's stretch of text is looked at at a time."""
    found, letter_before = BoundarySet(), False
    for high in range(len(text) // SPAN + 1):
        stretch = text[high * SPAN : (high + 1) * SPAN]
        code = np.frombuffer(stretch.encode("utf-32-le", "surrogatepass"), np.uint32)
        folded = code | 0x20
        letter = (folded >= 0x61) & (folded <= 0x7A)
        starts = np.ones(len(code) + 1, bool)
        starts[1:-1] = ~(letter[1:] & letter[:-1])
        if len(code):
            starts[0] = not (letter_before and letter[0])
            letter_before = bool(letter[-1])
        # The place after the last code point is the end of the text, or the
        # first one of the next stretch, which decides for itself.
        if len(code) == SPAN:
            starts = starts[:-1]
        found.add(high, np.flatnonzero(starts))
    return found


def cut_offsets(text: str, first: int, second: int) -> tuple[int, int, int]:
    """Tokens of the text, and the code points before its cuts at ``first % (n +
    1)`` and ``second % (n + 1)`` tokens, the smaller one first."""
    found = boundaries(text)
    n = len(found) - 1
    a, b = sorted((first % (n + 1), second % (n + 1)))
    return n, found.select(a), found.select(b)


def draw(key: object) -> list[int]:
    """The first four 32-bit numbers of the key's digest; NULL is drawn as an empty key."""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(key: object, text: str, plain_from: int = 90, spm_below: int = 20) -> tuple[int, str, int | None, int | None, str]:
    """Tokens, form, code points of prefix and middle, and the output text."""
    h1, h2, h3, h4 = draw(key)
    n, a, b = cut_offsets(text, h1, h2)
    if not text or h3 % 100 >= plain_from or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_below:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(form: str, output: str) -> str:
    """The text that :func:`transform` made ``output`` from.

    A transformed text holds no marker of its own, and none can arise where a
    marker meets text: it would have to begin inside another marker.
    """
    if form == "plain":
        return output
    head, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(head):
        raise ValueError(f"not an output of form {form}")
    one, rest = output[len(head) :].split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return prefix + middle + suffix


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """One row per row of ``docs``: its key, ``n``, ``form``, ``prefix_chars``,
    ``middle_chars``, the transformed ``output``, and ``restored``, the text
    rebuilt from form and output.

    No shuffle: a row's cuts depend on its key and text alone, so repeated rows
    and ties give equal rows. NULL and empty texts have no token and stay plain;
    a NULL key is drawn as an empty one. Columns of other names are not read, so
    none clashes. A very long text is cut container by container; only a few
    copies of it are held. An empty table gives an empty one.
    """
    kind = docs.schema[key].dataType
    schema = T.StructType(
        [T.StructField(key, kind)]
        + [T.StructField("n", T.LongType()), T.StructField("form", T.StringType())]
        + [T.StructField(c, T.LongType()) for c in ("prefix_chars", "middle_chars")]
        + [T.StructField(c, T.StringType()) for c in ("output", "restored")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, ready in _flushed(zip(batch.column(0), batch.column(1), batch.column(2)), plain_from, spm_below):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(ready[0])), *_columns(ready)], names=schema.names)

    rows = docs.select(F.col(f"`{key}`"), F.col(f"`{key}`").cast("string").alias("_drawn"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    return rows.mapInArrow(run, schema)


# Output of this many code points is handed on at once.
_FLUSH = 4_000_000


def _flushed(rows, plain_from: int, spm_below: int):
    """(first row, columns) of runs of rows whose output stays small."""
    done, first, size = [], 0, 0
    for _, drawn, text in rows:
        body = text.as_py()
        n, form, prefix, middle, output = transform(drawn.as_py(), body, plain_from, spm_below)
        done.append((n, form, prefix, middle, output, restore(form, output)))
        size += len(output)
        if size >= _FLUSH:
            yield first, list(zip(*done))
            first, done, size = first + len(done), [], 0
    if done:
        yield first, list(zip(*done))


def _columns(ready) -> list[pa.Array]:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    return [pa.array(values, kind) for values, kind in zip(ready, kinds)]
