"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Small inputs keep all cores busy; large ones are merged to the size above.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Planned sizes are those of compressed files; in memory they grow.
    "spark.sql.autoBroadcastJoinThreshold": "4m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    # A table in buckets is always read by them, so that what a load writes from
    # it stays in as many files.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(
    app: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Session with adaptive execution on and the UTC time zone.

    On a cluster start from many shuffle partitions (input bytes / 128 MB is a
    good first value) and let adaptive execution merge the small ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    A temporary folder of this machine is used only in local mode with the
    setting unset, as in tests.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get(CHECKPOINT_KEY) or spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    active = sc.getCheckpointDir()
    if active:
        return active.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return sc.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/work/{name}-{uuid.uuid4().hex}"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of what is written inside once it is there,
    and then collects the driver's garbage. A frame collected inside can not be
    collected again; use it for writes only."""
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP_KEY) if before is None else spark.conf.set(CLEANUP_KEY, before)
    spark.sparkContext._jvm.System.gc()


def stage(df: DataFrame, name: str = "stage", release: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy survives the loss of any executor, and every later use of the
    returned frame sees exactly the same rows. With ``release`` Spark deletes the
    shuffle files that led to the copy once it is written, and then collects the
    driver's garbage, as it does from time to time, so that its cleaner deletes
    those of earlier jobs.
    """
    path = work_path(df.sparkSession, name)
    with released(df.sparkSession) if release else nullcontext():
        df.write.parquet(path)
    copy = df.sparkSession.read.schema(df.schema).parquet(path)
    copy._staged_at = path
    if _SCOPES:
        _SCOPES[-1].append(copy)
    return copy


_SCOPES: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Copies staged inside are deleted at the end, also of a run that fails.

    Put a whole load inside, up to its commit: what it returns must not read them.
    A copy given to the function that this yields stays, for the scope outside.
    """
    _SCOPES.append([])
    try:
        yield _keep
    finally:
        discard(*_SCOPES.pop())


def _keep(copy: DataFrame) -> DataFrame:
    _SCOPES[-1][:] = [c for c in _SCOPES[-1] if c is not copy]
    if len(_SCOPES) > 1:
        _SCOPES[-2].append(copy)
    return copy


def discard(*copies: DataFrame) -> None:
    """Delete copies that :func:`stage` made and that nothing will read again."""
    for copy in copies:
        spark = copy.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(copy._staged_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
