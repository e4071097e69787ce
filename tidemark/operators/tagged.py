"""The next state of a table and the rows that changed, in one frame.

An operator that computes a next state knows each changed row. Asked for a feed,
it marks its rows: ``_out`` is ``state`` for a row of the next state and ``feed``
for a row of the change feed, whose ``_change_type`` says what happened to it.
One job then writes both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

OUT, CHANGE = "_out", "_change_type"
STATE, FEED = "state", "feed"


def unchanged(df: DataFrame) -> DataFrame:
    """Rows that stay as they are."""
    return df.withColumns({OUT: F.lit(STATE), CHANGE: F.lit(None).cast("string")})


def told(df: DataFrame, columns: Sequence[str], after: Column, before: Column | None, kind: Column) -> DataFrame:
    """Rows of the next state with their events.

    ``after`` and ``before`` are structs of ``columns``; ``kind`` is ``insert``,
    ``update`` or NULL for a row that did not change. An update has two events.
    """

    def event(out: str, change: str | None, row: Column) -> Column:
        return F.struct(F.lit(out).alias("out"), F.lit(change).cast("string").alias("change"), row.alias("row"))

    events = [event(STATE, None, after), F.when(kind == "insert", event(FEED, "insert", after))]
    if before is not None:
        events += [
            F.when(kind == "update", event(FEED, "update_preimage", before)),
            F.when(kind == "update", event(FEED, "update_postimage", after)),
        ]
    one = df.select(F.explode(F.array_compact(F.array(*events))).alias("_event"))
    return one.select(*[F.col(f"_event.row.{c}").alias(c) for c in columns], F.col("_event.out").alias(OUT), F.col("_event.change").alias(CHANGE))


def state_of(df: DataFrame) -> DataFrame:
    return df.filter(F.col(OUT) == STATE).drop(OUT, CHANGE)


def feed_of(df: DataFrame) -> DataFrame:
    return df.filter(F.col(OUT) == FEED).drop(OUT)
