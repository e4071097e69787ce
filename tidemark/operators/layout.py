"""File layout of a written table."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.session import stage

# Ranges of a column, at most: more files than this many cells gain nothing.
MOST_BITS = 10


def _text_borders(df: DataFrame, name: str, ranges: int) -> list:
    """The least value of each part of a range partitioning by the whole value."""
    parts = df.select(name).filter(F.col(name).isNotNull()).repartitionByRange(ranges, name)
    least = parts.groupBy(F.spark_partition_id().alias("_at")).agg(F.min(name).alias("_least"))
    return sorted({r["_least"] for r in least.collect()})[1:]


def _as_number(kind: T.DataType, name: str) -> Column:
    c = F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def _reached(value: Column, text: bool):
    """A border of text is the least value beyond it, of numbers the greatest before it."""
    return lambda border: (border <= value) if text else (border < value)


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.BinaryType))


@dataclass(frozen=True)
class Borders:
    """Borders of equal row counts in some columns, and the curve through them.

    They can be stored as text, so that rows that come later are laid out by the
    borders of those that came first.
    """

    cols: tuple[str, ...]
    bits: int
    cuts: tuple[tuple, ...]

    def dump(self) -> str:
        return json.dumps([self.cols, self.bits, self.cuts])

    @staticmethod
    def load(text: str) -> Borders:
        cols, bits, cuts = json.loads(text)
        return Borders(tuple(cols), bits, tuple(map(tuple, cuts)))

    def key(self, schema: T.StructType) -> Column:
        """One number per row that is near for rows near in all the columns: the
        interleaved bits of the numbers of the ranges that its values fall in."""
        key = F.lit(0).cast("long")
        for i, (c, borders) in enumerate(zip(self.cols, self.cuts)):
            text = _is_text(schema[c].dataType)
            value = F.col(c) if text else _as_number(schema[c].dataType, c)
            listed = F.array(*[F.lit(b) for b in borders]) if borders else F.array().cast("array<double>")
            below = F.size(F.filter(listed, _reached(value, text)))
            at = F.coalesce(F.when(value.isNotNull(), below), F.lit(0))
            for bit in range(self.bits):
                one = F.shiftright(at, bit).bitwiseAND(F.lit(1)).cast("long")
                key = key + F.shiftleft(one, bit * len(self.cols) + i)
        return key

    def cell(self, key: Column, cells: int) -> Column:
        """Stretches of the curve, at least ``cells`` of them."""
        wanted = min((cells - 1).bit_length(), self.bits * len(self.cols))
        return F.shiftright(key, self.bits * len(self.cols) - wanted).cast("int")


def find_borders(df: DataFrame, cols: Sequence[str], files: int) -> Borders:
    """Borders that make at least two cells for each file. Only they reach the driver."""
    bits = min(MOST_BITS, max(2, -(-(2 * files - 1).bit_length() // len(cols))))
    numbers = [c for c in cols if not _is_text(df.schema[c].dataType)]
    cuts = [i / 2**bits for i in range(1, 2**bits)]
    # One pass for all columns of numbers and times.
    found = df.agg(*[F.percentile_approx(_as_number(df.schema[c].dataType, c), cuts).alias(c) for c in numbers]).first() if numbers else {}
    given = {c: sorted(set(found[c] or [])) for c in numbers}
    return Borders(tuple(cols), bits, tuple(tuple(given[c] if c in given else _text_borders(df, c, 2**bits)) for c in cols))


def z_key(df: DataFrame, cols: Sequence[str], files: int) -> Column:
    """The place of each row on a curve through ``cols`` (see :class:`Borders`)."""
    return find_borders(df, cols, files).key(df.schema)


def cluster(df: DataFrame, cols: Sequence[str], files: int) -> DataFrame:
    """Rows with near values of ``cols`` in the same of ``files`` partitions.

    The borders, the sample of the range partitioning and the write each read the rows, so these
    are staged first and computed once. The row hash and the place in the copy
    follow the key, so that a value held by very many rows, even exact copies,
    is spread over several files.
    """
    df = stage(df, "cluster")
    key = z_key(df, cols, files) if len(cols) > 1 else F.col(cols[0])
    salted = df.withColumns(
        {"_z": key, "_h": F.xxhash64(*df.columns), "_from": F.monotonically_increasing_id()}
    )
    return (
        salted.repartitionByRange(files, "_z", "_h", "_from")
        .sortWithinPartitions("_z", *cols)
        .drop("_z", "_h", "_from")
    )


def cluster_write(df: DataFrame, path: str, cols: Sequence[str], files: int) -> None:
    """Write clustered files; the footers' minima and maxima then prune reads."""
    cluster(df, cols, files).write.mode("errorifexists").parquet(path)


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str], mode: str = "errorifexists") -> None:
    """One directory per value of ``cols``.

    The rebalance hint gathers a value in few files and lets adaptive execution
    split the values that are too large for one.
    """
    df.hint("rebalance", *cols).write.mode(mode).partitionBy(*cols).parquet(path)
