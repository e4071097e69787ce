"""Incremental loads: new raw files or new table versions into a next version.

The operators are the batch ones. Structured Streaming only finds what is new
and remembers what was read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.operators.changes import next_start, set_watermark, table_changes
from tidemark.session import stage
from tidemark.sources.snapshots import (
    latest_version,
    read_differences,
    read_feed,
    read_snapshot,
    replace,
    snapshot_log,
    versions,
)


def follow_files(
    arriving: DataFrame,
    path: str,
    empty: DataFrame,
    load: Callable[[DataFrame, DataFrame], DataFrame],
    checkpoint: str,
) -> int:
    """Load everything that has arrived on the stream since the last call.

    ``load(target, batch)`` gives the next state of the table at ``path``. Each
    micro-batch writes one version and leaves its number in the version's note;
    a batch that is repeated after a failure finds its note and is skipped.
    Returns the latest version.
    """
    spark = arriving.sparkSession

    def one(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        note = f"batch {number} of {checkpoint}"
        if not snapshot_log(session, path).filter(F.col("note") == note).isEmpty():
            return
        started = latest_version(session, path) is not None
        target = read_snapshot(session, path) if started else empty
        # Stored once: a load reads its batch several times.
        replace(load(target, stage(batch, "micro-batch")), path, note)

    query = (
        arriving.writeStream.foreachBatch(one)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return latest_version(spark, path)


def pull_changes(
    spark: SparkSession,
    control: DataFrame,
    table: str,
    path: str,
    keys: Sequence[str],
    as_of=None,
    among: Sequence[str] = (),
    end: int | None = None,
) -> tuple[DataFrame | None, DataFrame]:
    """Changes of a stored table since its control row, up to version ``end``
    (default: the latest), and the next control.

    Store the returned control only after the changes were applied; until then
    a repeated call returns the same changes. None means nothing is new.
    A version whose load wrote its changes is read from these, and its table
    folders are not opened; of other versions the folders that differ are
    compared. Where several rows of such a version share ``keys``, their places
    by ``among`` and then by the other columns tell them apart.
    """

    def placed(rows: DataFrame) -> DataFrame:
        if not among:
            return rows
        rest = [c for c in rows.columns if c not in {*keys, *among}]
        return rows.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*among, *rest)))

    row = [*keys, "_place"] if among else keys
    start, last = next_start(control, table), latest_version(spark, path)
    if end is not None and last is not None:
        last = min(last, end)
    if last is None or last < start:
        return None, control
    feed, known = None, versions(spark, path, max(start - 1, 1), last)
    for version, now in known.items():
        if version < start:
            continue
        if now.feed is not None:
            one = read_feed(spark, path, now).withColumn("_commit_version", F.lit(version))
        else:
            old, new = read_differences(spark, path, known.get(version - 1), now)
            one = table_changes({version - 1: placed(old), version: placed(new)}, version, row, end=version).drop("_place")
        feed = one if feed is None else feed.unionByName(one, allowMissingColumns=True)
    return feed, set_watermark(control, table, last, as_of)
