"""Slowly changing history (type 2): every change of a watched column closes
the current row of its key and opens a new one.

A history row carries ``is_current``, ``end_date`` and a load stamp. The
operators compute the whole next state from one version of the target, so a
run either lands completely or not at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import norm_xml
from tidemark.operators.skew import by_heat, hot_keys
from tidemark.operators.tagged import CHANGE, OUT, told, unchanged
from tidemark.operators.timeline import differs, latest_per_key, neighbours, per_key
from tidemark.operators.upsert import new_keys
from tidemark.session import stage

END_OF_TIME = "9999-12-31"
LOAD_COL = "_ingestion_timestamp"

_FLOOR, _CURRENT, _BATCH = 0, 1, 2


def current(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_current"))


def closed(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_current"))


def load_stamp(as_of: datetime | str | None) -> Column:
    """``as_of`` when given (repeatable runs), else the clock."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def end_of_time(df: DataFrame, order: str) -> Column:
    return F.lit(END_OF_TIME).cast(df.schema[order].dataType)


def watched_struct(monitored: Sequence[str], normalise: Sequence[str] = ()) -> Column:
    """The watched columns; those in ``normalise`` without gaps between tags."""
    return F.struct(*[(norm_xml(F.col(c)) if c in normalise else F.col(c)).alias(c) for c in monitored])


def changed_keys(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    monitored: Sequence[str],
    order: str,
    *,
    null_safe: bool = True,
    normalise: Sequence[str] = (),
    newest_only: bool = False,
    ties: Sequence[str] = (),
    ignore_older: bool = True,
) -> DataFrame:
    """Keys with a current row that some batch row changes, and the date on
    which that row closes (``new_end_date``, the earliest changing row).

    ``newest_only`` compares just the newest batch row of each key.
    ``ignore_older=False`` also takes batch rows dated before the current row.
    """
    if newest_only:
        batch = latest_per_key(batch, keys, [order, *ties])
    now = current(target).select(
        *keys, watched_struct(monitored, normalise).alias("_now"), F.col(order).alias("_since")
    )
    found = batch.select(*keys, order, watched_struct(monitored, normalise).alias("_new"))
    found = found.join(now, list(keys)).filter(
        differs(F.col("_new"), F.col("_now"), monitored, null_safe)
    )
    if ignore_older:
        found = found.filter(F.col(order) >= F.col("_since"))
    return found.groupBy(*keys).agg(F.min(order).alias("new_end_date"))


def scd2_close(target: DataFrame, closing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Close the current row of every key in ``closing`` (keys, new_end_date)."""
    hit = F.col("is_current") & F.col("new_end_date").isNotNull()
    return (
        target.join(closing, list(keys), "left")
        .withColumns(
            {
                "end_date": F.when(hit, F.col("new_end_date")).otherwise(F.col("end_date")),
                "is_current": F.col("is_current") & F.col("new_end_date").isNull(),
            }
        )
        .select(*target.columns)
    )


def scd2_apply(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    monitored: Sequence[str],
    order: str,
    *,
    ties: Sequence[str] = (),
    null_safe: bool = True,
    normalise: Sequence[str] = (),
    latest_cols: Sequence[str] = (),
    load_col: str = LOAD_COL,
    as_of: datetime | str | None = None,
    hot_rows: int | None = None,
    ends: bool = False,
    feed: bool = False,
    buckets: int | None = None,
    newest_only: bool = False,
) -> DataFrame:
    """Next state of ``target`` after ``batch``.

    * A known key gets the batch rows dated at or after its current row that
      change a watched column; the row before each of them ends on its date.
    * With ``newest_only`` a key with a current row gets just the newest of its
      batch rows, if that one is not older and differs; versions between the two
      are not kept, so that intervals still touch.
    * A new key gets all its versions.
    * A key with closed rows only (left by an interrupted run) continues after
      the last of them.
    * Of several batch rows with one key and date, the last by ``ties`` and then
      by the other columns stays.
    * ``latest_cols`` take the newest batch value on every inserted row.
    * With nothing watched only new keys are added.
    * A row without a date has no place in the order and fails the load; take
      such rows out before with :func:`undated`.
    * With ``ends``, ``order`` of a closed row is the time at which it ended, and
      batch rows before the last such time are known.
    * With ``feed`` the rows are tagged (:mod:`tidemark.operators.tagged`): a
      closed row is an update, a new one an insert.
    * ``buckets`` says that the target is stored in so many buckets by ``keys``
      (:mod:`tidemark.sources.bucketed`). Only the batch is then exchanged, and
      the next state lies in the same buckets. A hot key gives that up.

    Keys absent from the batch and closed rows are passed through untouched.
    """
    keys = list(keys)
    state = [load_col, "is_current", "end_date"]
    data = [c for c in target.columns if c not in state]
    # Stored once: the probe, the target's filters and the history all read it.
    batch = stage(_dated(batch.select(*data).na.drop(subset=keys), order), "batch")
    # The remaining columns complete the order, so equal dates never tie.
    ties = [*ties, *[c for c in data if c not in {*keys, order, *ties}]]
    if not monitored:
        batch = new_keys(batch, target, keys)
    hot = hot_keys(batch, keys, hot_rows)
    if buckets:
        batch = batch.repartition(buckets, *keys)
    if latest_cols:
        batch = _spread_latest(batch, keys, order, ties, latest_cols, hot)

    stamp = load_stamp(as_of).cast(target.schema[load_col].dataType)
    incoming = batch.select(*data, stamp.alias(load_col), F.lit(_BATCH).alias("_kind"))
    if monitored:
        in_batch = batch.select(*keys).distinct()
        now = current(target)
        open_rows = now.join(in_batch, keys, "left_semi")
        kept = closed(target).unionByName(now.join(in_batch, keys, "left_anti"))
        floor = (
            closed(target).join(in_batch, keys, "left_semi").groupBy(*keys).agg(F.max(order).alias(order))
        )
        line = incoming.unionByName(
            open_rows.select(*data, load_col, F.lit(_CURRENT).alias("_kind"))
        ).unionByName(floor.withColumn("_kind", F.lit(_FLOOR)), allowMissingColumns=True)
    else:
        kept, line = target, incoming

    watched = watched_struct(monitored, normalise)

    def plan(rows: DataFrame, heavy: bool) -> DataFrame:
        return _history(rows, keys, order, ties, monitored, watched, null_safe, heavy, ends, newest_only)

    lines = by_heat(line, keys, hot, plan)
    forever = end_of_time(target, order).cast(target.schema["end_date"].dataType)
    is_open = F.col("_newer").isNull()
    values = {
        "is_current": is_open,
        "end_date": F.coalesce(F.col("_newer.at").cast(target.schema["end_date"].dataType), forever),
    }
    if feed:
        # A row that was current before the load was open without end.
        was = {"is_current": F.lit(True), "end_date": forever}
        after, before = (F.struct(*[v.get(c, F.col(c)).alias(c) for c in target.columns]) for v in (values, was))
        kind = F.when(F.col("_kind") == _BATCH, "insert").when(~is_open, "update")
        return unchanged(kept).unionByName(told(lines, target.columns, after, before, kind)).select(*target.columns, OUT, CHANGE)
    fresh = lines.select(*data, load_col, *[v.alias(c) for c, v in values.items()])
    return kept.unionByName(fresh).select(*target.columns)


def undated(batch: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows with a key that cannot be placed in its history."""
    return batch.na.drop(subset=list(keys)).filter(F.col(order).isNull())


def _dated(batch: DataFrame, order: str) -> DataFrame:
    message = F.lit(f"a batch row has no {order}; see undated()")
    failed = F.raise_error(message).cast("boolean")
    return batch.filter(F.when(F.col(order).isNull(), failed).otherwise(True))


def _spread_latest(batch, keys, order, ties, latest_cols, hot):
    def plan(rows: DataFrame, heavy: bool) -> DataFrame:
        newest = F.max_by(F.struct(*latest_cols), F.struct(order, *ties))
        return per_key(rows, keys, {"_newest": newest}, heavy)

    found = by_heat(batch, keys, hot, plan)
    return found.withColumns({c: F.col(f"_newest.{c}") for c in latest_cols}).drop("_newest")


def _history(rows, keys, order, ties, monitored, watched, null_safe, heavy, ends, newest_only):
    """Batch, current and floor rows of some keys -> their new history lines.

    All windows share one partitioning and one sort.
    """
    kind, at = F.col("_kind"), F.col(order)
    line = [order, "_kind", *ties]

    # One batch row per key and date.
    if heavy:
        rows = latest_per_key(rows, [*keys, order, "_kind"], ties)
    else:
        rows = neighbours(
            rows, keys, line, following={"_newer": F.struct(at.alias("at"), kind.alias("kind"))}
        )
        repeated = F.col("_newer").isNotNull() & F.col("_newer.at").eqNullSafe(at)
        rows = rows.filter((kind != _BATCH) | ~repeated).drop("_newer")

    # Batch rows older than what the target already says are dropped.
    rows = per_key(
        rows,
        keys,
        {
            "_since": F.max(F.when(kind == _CURRENT, at)),
            "_floor": F.max(F.when(kind == _FLOOR, at)),
            "_known": F.min("_kind"),
            **({"_newest": F.max(F.when(kind == _BATCH, at))} if newest_only else {}),
        },
        heavy,
    )
    has_current = F.col("_since").isNotNull()
    late_enough = (
        F.when(has_current, at >= F.col("_since"))
        .when(F.col("_floor").isNotNull(), at > F.col("_floor"))
        .otherwise(F.lit(True))
    )
    if ends:
        late_enough = F.coalesce(at >= F.greatest("_since", "_floor"), F.lit(True))
    if newest_only:
        late_enough = late_enough & (~has_current | (at == F.col("_newest")))
    rows = rows.filter(
        (kind == _CURRENT) | ((kind == _BATCH) & late_enough)
    )

    # A known key keeps only rows that change a watched column.
    if monitored:
        rows = neighbours(rows, keys, line, prev={"_older": watched}, heavy=heavy)
        rows = rows.filter(
            (kind == _CURRENT)
            | (F.col("_known") == _BATCH)
            | F.col("_older").isNull()
            | differs(watched, F.col("_older"), monitored, null_safe)
        )
    return neighbours(rows, keys, line, following={"_newer": F.struct(at.alias("at"))}, heavy=heavy)

