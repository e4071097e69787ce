"""Change feed between table versions, and the control table of a pipeline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.scd2 import load_stamp
from tidemark.operators.upsert import merge_upsert

POST_IMAGES = ("insert", "update_postimage")
CONTROL_SCHEMA = "table_name string, last_version int, last_run_timestamp timestamp"


def table_changes(
    snapshots: Mapping[int, DataFrame], start: int, keys: Sequence[str], end: int | None = None
) -> DataFrame:
    """Row changes of versions ``start`` .. ``end``, both inclusive.

    Adds ``_change_type`` (insert, update_preimage, update_postimage, delete)
    and ``_commit_version``. ``keys`` identify a row within a version; a key
    that occurs twice in one version fails the job. The version before
    ``start`` must be given, unless ``start`` is the first one.

    All versions go through one shuffle and one sort: a row only has to look at
    its own key in the version before and after it.
    """
    end = max(snapshots) if end is None else end
    versions = [v for v in sorted(snapshots) if v <= end]
    if start not in versions:
        raise ValueError(f"version {start} is not among {versions}")
    versions = versions[max(versions.index(start) - 1, 0) :]
    columns = snapshots[versions[0]].columns
    content = F.struct(*[c for c in columns if c not in keys] or [F.lit(1).alias("_none")])

    rows = None
    for at, version in enumerate(versions):
        tagged = snapshots[version].select(*columns, F.lit(at).alias("_at"))
        rows = tagged if rows is None else rows.unionByName(tagged)

    line = Window.partitionBy(*keys).orderBy("_at")
    rows = rows.withColumns(
        {
            "_before": F.lag(F.struct(F.col("_at").alias("at"), content.alias("row"))).over(line),
            "_after": F.lead(F.struct(F.col("_at").alias("at"), content.alias("row"))).over(line),
        }
    )
    at, before, after = F.col("_at"), F.col("_before"), F.col("_after")
    was_there = F.coalesce(before["at"] == at - 1, F.lit(False))
    stays = F.coalesce(after["at"] == at + 1, F.lit(False))
    # Changes start with the second version read, or with the first version of all.
    first = 1 if versions[0] != start else 0
    repeated = F.coalesce(before["at"] == at, F.lit(False))
    message = F.lit(f"a key ({', '.join(keys)}) occurs twice in one version")

    def event(kind: str, step: int, when: Column) -> Column:
        return F.when(
            when, F.struct(F.lit(kind).alias("kind"), (at + step).cast("int").alias("at"))
        )

    same_before = before["row"].eqNullSafe(content)
    same_after = after["row"].eqNullSafe(content)
    events = F.array_compact(
        F.array(
            event("insert", 0, (at >= first) & ~was_there),
            event("update_postimage", 0, (at >= first) & was_there & ~same_before),
            event("update_preimage", 1, stays & ~same_after),
            event("delete", 1, ~stays & (at < len(versions) - 1)),
        )
    )
    checked = F.when(repeated, F.raise_error(message).cast(_event_type())).otherwise(events)
    numbers = F.array(*[F.lit(v) for v in versions])
    return rows.select(*columns, F.explode(checked).alias("_event")).select(
        *columns,
        F.col("_event.kind").alias("_change_type"),
        numbers[F.col("_event.at")].alias("_commit_version"),
    )


def _event_type() -> str:
    return "array<struct<kind:string,at:int>>"


def post_images(changes: DataFrame) -> DataFrame:
    """New and updated rows as they are after the change."""
    return changes.filter(F.col("_change_type").isin(*POST_IMAGES))


def empty_control(spark) -> DataFrame:
    return spark.createDataFrame([], CONTROL_SCHEMA)


def get_watermark(control: DataFrame, table: str) -> int | None:
    """Last processed version of ``table``, None before its first run."""
    row = control.filter(F.col("table_name") == table).select("last_version").first()
    return None if row is None else row[0]


def next_start(control: DataFrame, table: str, first: int = 1) -> int:
    """Version to read from: the start of a change feed is inclusive."""
    last = get_watermark(control, table)
    return first if last is None else last + 1


def merge_watermarks(control: DataFrame, updates: DataFrame) -> DataFrame:
    """Update or add one control row per table of ``updates``."""
    return merge_upsert(control, updates, ["table_name"])


def set_watermark(
    control: DataFrame, table: str, version: int, as_of: datetime | str | None = None
) -> DataFrame:
    """Next state of the control table after ``table`` was read up to ``version``."""
    row = control.sparkSession.range(1).select(
        F.lit(table).alias("table_name"),
        F.lit(version).alias("last_version"),
        load_stamp(as_of).alias("last_run_timestamp"),
    )
    return merge_watermarks(control, row)
