"""Find keys that hold too many rows for one task and treat them apart."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.session import stage

# A key with more rows than this is spread over several tasks. Lower it for
# tables whose rows are wide; it does not move with the input.
HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame | None:
    """Keys with more than ``rows`` rows, or None when there are none.

    One job at every size: the counts are combined before the shuffle, so the
    probe itself has no hot task, and the few keys that pass are written to the
    shared folder. There are fewer than (rows of ``df``) / ``rows`` of them.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = stage(counts.filter(F.col("_n") > (HOT_ROWS if rows is None else rows)).select(*keys), "hot-keys")
    return None if hot.isEmpty() else hot


def match_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; the keys come from ``left``."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    test = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, test, how).drop(*[f"_r_{k}" for k in keys])


def by_heat(
    df: DataFrame,
    keys: Sequence[str],
    hot: DataFrame | None,
    plan: Callable[[DataFrame, bool], DataFrame],
) -> DataFrame:
    """Run ``plan(rows, heavy)`` on the normal keys and on the hot keys.

    ``hot`` comes from :func:`hot_keys`. It is stored, so Spark knows its size
    and broadcasts it where that is safe; a larger one is a join that splits
    skewed keys.
    """
    if hot is None:
        return plan(df, False)
    normal = plan(match_keys(df, hot, keys, "left_anti"), False)
    heavy = plan(match_keys(df, hot, keys, "left_semi"), True)
    return normal.unionByName(heavy)
