"""Insert-if-absent and merge as next-state functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.operators.tagged import told
from tidemark.session import stage


def present_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``source`` that ``target`` holds.

    The target is reduced by the source's keys first: with a small source that
    is a broadcast filter and the target is not shuffled.
    """
    wanted = source.select(*keys).distinct()
    return target.select(*keys).join(wanted, list(keys), "left_semi").distinct()


def new_keys(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose key is absent from ``target``."""
    return source.join(present_keys(target, source, keys), list(keys), "left_anti")


def restrict_to_keys(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys_df``."""
    return df.join(keys_df.select(*keys).distinct(), list(keys), "left_semi")


def insert_if_absent(
    target: DataFrame, source: DataFrame, keys: Sequence[str], one_per_key: bool = False
) -> DataFrame:
    """``target`` plus the rows of ``source`` with an unseen key.

    With ``one_per_key`` a key of several source rows gets the greatest of them,
    so that the key stays unique in the target.
    """
    if one_per_key:
        rest = [c for c in source.columns if c not in keys]
        order = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in rest] or [F.lit(1)])
        source = source.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")
    return target.unionByName(new_keys(source, target, keys).select(*target.columns))


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "source") -> None:
    """An error if stored rows hold a key twice. The keys are counted where they
    lie before they are exchanged."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys).first()
    if twice is not None:
        raise ValueError(f"{what} has more than one row for a key ({', '.join(keys)}), as for {tuple(twice)}")


def merge_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` computed once and checked: every later use, also with an empty
    target, reads the stored rows. Only the keys are exchanged for the check."""
    stored = stage(source, "merge-source", release=True)
    assert_unique(stored, keys)
    return stored


# Of such keys equal ones are the same value.
_PLAIN = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType)


def _replaces(target: DataFrame, source: DataFrame, keys: list[str], update_cols: Sequence[str], stamp: dict[str, Column]) -> bool:
    """Whether a match leaves nothing of the target's row that the source's row
    does not have too."""
    if not set(target.columns) <= {*keys, *update_cols, *stamp} or not {*keys} <= {*target.columns} & {*source.columns}:
        return False
    for k in keys:
        kind = target.schema[k].dataType
        if kind != source.schema[k].dataType or not (isinstance(kind, _PLAIN) or kind == T.StringType()):
            return False
    nothing = target.sparkSession.range(0).select(F.lit(1).alias("_none"))
    try:
        # A stamp that reads a column reads it in the target's row.
        nothing.select(*stamp.values())
    except AnalysisException:
        return False
    return True


def _replaced(target: DataFrame, source: DataFrame, keys: list[str], stamp: dict[str, Column]) -> DataFrame:
    """Rows of the target whose key is not in ``source``, and those of ``source``,
    which are not exchanged. One that matches several rows comes as often."""
    wanted = source.select(*keys)
    held = target.select(*keys).join(wanted, keys, "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    twice = stage(held.filter("_n > 1"), "held-twice", release=True)
    if not twice.isEmpty():
        times = F.sequence(F.lit(1).cast("long"), F.coalesce("_n", F.lit(1)))
        source = source.join(twice, keys, "left").withColumn("_n", F.explode(times)).drop("_n")
    rest = target.join(wanted, keys, "left_anti").select(*target.columns)
    return rest.unionByName(_as_target(source.withColumns(stamp), target))


def _as_target(rows: DataFrame, target: DataFrame) -> DataFrame:
    """The target's columns with its types; what ``rows`` lacks is NULL."""
    rows = rows.withColumns({c: F.lit(None) for c in target.columns if c not in rows.columns})
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema])


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert: bool = True,
    stamp: dict[str, Column] | None = None,
    checked: bool = False,
    feed: bool = False,
) -> DataFrame:
    """Update matched rows, insert the others.

    ``update_cols`` (default: all but the keys) limits what a match changes.
    ``stamp`` sets columns on every updated or inserted row. ``source`` must
    hold one row per key; ``checked`` says that it comes from
    :func:`merge_source`. With ``feed`` the rows are tagged
    (:mod:`tidemark.operators.tagged`); a match that changes no value is no event.

    Where a match takes the whole row from the source, only the keys of the source
    meet the target. Otherwise a left join plus an anti join instead of a full
    outer join. In both a small source is broadcast and the target keeps its
    place, and a hot target key can be split.
    """
    keys, stamp = list(keys), stamp or {}
    unique = source if checked else merge_source(source, keys)
    if update_cols is None:
        update_cols = [c for c in target.columns if c not in keys and c in source.columns]
    if insert and not feed and _replaces(target, unique, keys, update_cols, stamp):
        return _replaced(target, unique, keys, stamp)
    payload = F.struct(F.lit(True).alias("_hit"), *[c for c in update_cols if c not in stamp])
    joined = target.join(unique.select(*keys, payload.alias("_src")), keys, "left")
    hit = F.col("_src._hit").isNotNull()
    out = []
    for field in target.schema:
        c = field.name
        if c in stamp:
            out.append(F.when(hit, stamp[c].cast(field.dataType)).otherwise(F.col(c)).alias(c))
        elif c in update_cols:
            new = F.col(f"_src.{c}").cast(field.dataType)
            out.append(F.when(hit, new).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    if feed:
        after, before = F.struct(*out), F.struct(*target.columns)
        kind = F.when(hit & ~after.eqNullSafe(before), "update")
        merged = told(joined, target.columns, after, before, kind)
    else:
        merged = joined.select(*out)
    if not insert:
        return merged
    fresh = _as_target(new_keys(unique, target, keys).withColumns(stamp), target)
    if feed:
        fresh = told(fresh, target.columns, F.struct(*target.columns), None, F.lit("insert"))
    return merged.unionByName(fresh)
