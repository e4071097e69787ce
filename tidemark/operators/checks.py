"""Counts and probes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def count_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table, one row per table.

    Each count reads no column and is a partial count per task plus one final
    row; the counts run side by side in one job.
    """
    stacked = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count"))
        one = one.select(F.lit(name).alias("table_name"), "row_count")
        stacked = one if stacked is None else stacked.unionByName(one)
    return stacked


def probe_text(
    df: DataFrame, id_cols: Sequence[str], col: str, n: int = 5, order: Sequence[str] = ()
) -> DataFrame:
    """Length of ``col`` in ``n`` rows that have one; ``order`` makes the choice
    repeatable."""
    found = df.filter(F.col(col).isNotNull()).select(*id_cols, F.length(col).alias("chars"))
    return (found.orderBy(*order) if order else found).limit(n)


def open_rows_per_key(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of a history that do not have exactly one current row."""
    return (
        history.groupBy(*keys)
        .agg(F.count_if("is_current").alias("open_rows"))
        .filter(F.col("open_rows") != 1)
    )
