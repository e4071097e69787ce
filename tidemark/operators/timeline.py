"""Version order within a key: rank, neighbours, compression, latest value.

Every function orders by ``order`` and then by ``ties``. Together they must be
a total order up to interchangeable rows; that makes results repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.skew import by_heat, hot_keys, match_keys
from tidemark.session import stage

_SLOT, _FROM = "_slot", "_from"


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    prev: dict[str, Column] | None = None,
    following: dict[str, Column] | None = None,
    rank: str | None = None,
    rank_newest: str | None = None,
    heavy: bool = False,
) -> DataFrame:
    """Attach values of the older and the newer row of the same key.

    ``prev`` and ``following`` map a new struct column to the struct expression
    read from that neighbour (NULL at the end of the line). ``rank`` counts
    from the oldest row, ``rank_newest`` from the newest.

    ``heavy`` is the form for hot keys. The rows are range-partitioned on
    (keys, order), so one key is spread over many tasks and cut into slots.
    Windows run inside a slot, and what crosses a slot border comes from a
    summary with one row per (key, slot). A range border cuts at most one key,
    so that summary has at most (hot keys + partitions) rows.
    """
    prev, following = prev or {}, following or {}
    if heavy:
        return _neighbours_heavy(df, keys, order, prev, following, rank, rank_newest)
    oldest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    # One direction only, so that one sort serves all the columns.
    backwards = rank_newest is not None and rank is None
    line = newest_first if backwards else oldest_first
    older, newer = (F.lead, F.lag) if backwards else (F.lag, F.lead)
    cols = {name: older(value).over(line) for name, value in prev.items()}
    cols |= {name: newer(value).over(line) for name, value in following.items()}
    if rank:
        cols[rank] = F.row_number().over(oldest_first)
    if rank_newest:
        cols[rank_newest] = F.row_number().over(newest_first)
    return df.withColumns(cols)


def _neighbours_heavy(df, keys, order, prev, following, rank, rank_newest):
    keys, order = list(keys), list(order)
    spark = df.sparkSession
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The source partition separates exact copies of one row; it is the same on
    # every retry of a task. The staged copy fixes the slot of each row.
    placed = stage(
        df.withColumn(_FROM, F.spark_partition_id())
        .repartitionByRange(slots, *keys, *order, _FROM)
        .withColumn(_SLOT, F.spark_partition_id())
        .drop(_FROM),
        "slots",
    )
    at = F.struct(*order)
    summary = placed.groupBy(*keys, _SLOT).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max_by(value, at).alias(f"_last_{name}") for name, value in prev.items()],
        *[F.min_by(value, at).alias(f"_first_{name}") for name, value in following.items()],
    )
    chain = Window.partitionBy(*keys).orderBy(_SLOT)
    earlier = chain.rowsBetween(Window.unboundedPreceding, -1)
    later = chain.rowsBetween(1, Window.unboundedFollowing)
    border = summary.select(
        *keys,
        _SLOT,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_n").over(later), F.lit(0)).alias("_rows_after"),
        *[F.lag(f"_last_{name}").over(chain).alias(f"_in_{name}") for name in prev],
        *[F.lead(f"_first_{name}").over(chain).alias(f"_in_{name}") for name in following],
    )
    inside = Window.partitionBy(*keys, _SLOT).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    cols = {name: F.lag(value).over(inside) for name, value in prev.items()}
    cols |= {name: F.lead(value).over(inside) for name, value in following.items()}
    position = F.row_number().over(inside)
    cols["_pos"] = position
    cols["_left"] = F.count(F.lit(1)).over(Window.partitionBy(*keys, _SLOT)) - position
    ranked = placed.withColumns(cols)
    # Rows are few, but may be wide: Spark decides by their size.
    joined = match_keys(ranked, border, [*keys, _SLOT], "inner")
    out = [F.col(c) for c in df.columns]
    out += [F.coalesce(name, f"_in_{name}").alias(name) for name in [*prev, *following]]
    if rank:
        out.append((F.col("_rows_before") + F.col("_pos")).cast("int").alias(rank))
    if rank_newest:
        newest = F.col("_rows_after") + F.col("_left") + 1
        out.append(newest.cast("int").alias(rank_newest))
    return joined.select(*out)


def per_key(
    df: DataFrame, keys: Sequence[str], aggs: dict[str, Column], heavy: bool = False
) -> DataFrame:
    """Attach aggregates of the whole key to each of its rows.

    For hot keys they are aggregated first (with a map-side part) and joined
    back by a join that Spark splits where a key is skewed.
    """
    if not heavy:
        whole = Window.partitionBy(*keys)
        return df.withColumns({name: agg.over(whole) for name, agg in aggs.items()})
    totals = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggs.items()])
    return match_keys(df, totals, keys, "left")


def rank_versions(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    ties: Sequence[str] = (),
    hot_rows: int | None = None,
) -> DataFrame:
    """Add ``rn`` (1 = newest) and ``next_version_date`` (the older neighbour's
    date, that is LEAD over newest-first order)."""

    def plan(rows: DataFrame, heavy: bool) -> DataFrame:
        return neighbours(
            rows,
            keys,
            [order, *ties],
            prev={"_older": F.struct(F.col(order).alias("at"))},
            rank_newest="rn",
            heavy=heavy,
        )

    ranked = by_heat(df, keys, hot_keys(df, keys, hot_rows), plan)
    return ranked.withColumn("next_version_date", F.col("_older.at")).drop("_older")


def prev_values(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: Sequence[str],
    ties: Sequence[str] = (),
    hot_rows: int | None = None,
) -> DataFrame:
    """Add ``prev_<c>`` for each column: its value in the older version."""

    def plan(rows: DataFrame, heavy: bool) -> DataFrame:
        older = {"_older": F.struct(*cols)}
        return neighbours(rows, keys, [order, *ties], prev=older, heavy=heavy)

    found = by_heat(df, keys, hot_keys(df, keys, hot_rows), plan)
    return found.withColumns({f"prev_{c}": F.col(f"_older.{c}") for c in cols}).drop("_older")


def differs(a: Column, b: Column, fields: Sequence[str], null_safe: bool = True) -> Column:
    """True where two structs differ in any field.

    With ``null_safe=False`` a NULL on either side counts as no difference,
    like ``<>``.
    """
    tests = []
    for f in fields:
        if null_safe:
            tests.append(~a[f].eqNullSafe(b[f]))
        else:
            tests.append(F.coalesce(a[f] != b[f], F.lit(False)))
    found = F.lit(False)
    for test in tests:
        found = found | test
    return found


def compress_versions(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: Sequence[str],
    ties: Sequence[str] = (),
    null_safe: bool = True,
    hot_rows: int | None = None,
) -> DataFrame:
    """Keep the first version of each key and those that differ from the
    version before them."""

    def plan(rows: DataFrame, heavy: bool) -> DataFrame:
        older = {"_older": F.struct(*cols)}
        return neighbours(rows, keys, [order, *ties], prev=older, heavy=heavy)

    found = by_heat(df, keys, hot_keys(df, keys, hot_rows), plan)
    changed = differs(F.struct(*cols), F.col("_older"), cols, null_safe)
    return found.filter(F.col("_older").isNull() | changed).drop("_older")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str], rank: str = "_rn"
) -> DataFrame:
    """One row per key, the greatest by ``newest``.

    Spark keeps at most one row per key in each map task before the shuffle, so
    a hot key sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in newest])
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) == 1).drop(rank)


def with_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: Sequence[str],
    ties: Sequence[str] = (),
    hot_rows: int | None = None,
) -> DataFrame:
    """Give every version of a key the newest version's value of ``cols``."""
    others = [c for c in df.columns if c not in cols]

    def plan(rows: DataFrame, heavy: bool) -> DataFrame:
        newest = F.max_by(F.struct(*cols), F.struct(order, *ties))
        return per_key(rows, keys, {"_newest": newest}, heavy)

    found = by_heat(df, keys, hot_keys(df, keys, hot_rows), plan)
    latest = {c: F.col(f"_newest.{c}") for c in cols}
    return found.select(*[latest[c].alias(c) if c in latest else c for c in [*others, *cols]])
