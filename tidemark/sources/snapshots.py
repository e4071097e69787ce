"""Versions of a table as parquet folders plus a log.

Rows live below ``path/data`` and ``path/log`` holds one file per version. A
version is written to a folder of its own name and becomes visible with its log
file, so a plan never overwrites what it reads, and what a failed run leaves
behind hinders neither readers nor later writers. Of two writers of the same
version the second one's log file is refused.

A table may be dealt to slots (:class:`Slots`): a version then consists of one
folder per slot and :func:`replace_slots` writes only the slots that a load
touches, and beside them, in the same job, the rows that the load changed. The
log names what a version added and removed. It names all folders where these are
few, and every ``FULL_EVERY`` versions, so that a reader opens a bounded number of
log files and the log does not grow with the square of the versions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.functions.calendar import month_key
from tidemark.operators.layout import Borders, cluster, find_borders
from tidemark.operators.tagged import CHANGE, FEED, OUT, STATE
from tidemark.session import released

LOG_SCHEMA = (
    "version int, committed_at timestamp, rows long, note string, folders array<string>, "
    "added array<string>, removed array<string>, feed string, slots string, borders string, table_schema string"
)
FULL_EVERY = FEW = 16
_SLOT, _CELL, _Z = "_slot", "_cell", "_z"


@dataclass(frozen=True)
class Slots:
    """How rows are dealt to folders: by a hash of key columns, by the month of a
    yyyyMMdd column, or by a year and a month column."""

    kind: str
    columns: tuple[str, ...]
    count: int = 0

    @staticmethod
    def by_hash(columns: Sequence[str], count: int) -> Slots:
        return Slots("hash", tuple(columns), count)

    @staticmethod
    def by_month(day_key: str) -> Slots:
        return Slots("month", (day_key,))

    @staticmethod
    def by_year_and_month(year: str, month: str) -> Slots:
        return Slots("year and month", (year, month))

    def __str__(self) -> str:
        return json.dumps([self.kind, self.columns, self.count])

    def of(self, schema: T.StructType) -> Column:
        """The slot of a row, from its columns as the table declares them. Rows
        without a date are in slot 0."""
        cols = [F.col(c).cast(schema[c].dataType) for c in self.columns]
        if self.kind == "hash":
            return F.pmod(F.xxhash64(*cols), F.lit(self.count)).cast("int")
        month = month_key(cols[0]) if self.kind == "month" else (cols[0] * 100 + cols[1]).cast("int")
        return F.coalesce(month, F.lit(0))

    def touched(self, batch: DataFrame, schema: T.StructType) -> list[int]:
        """Slots that rows of ``batch`` belong to: as many as hashes or months."""
        return sorted(r[0] for r in batch.select(self.of(schema)).distinct().collect())


@dataclass
class Version:
    version: int
    rows: int
    note: str
    folders: list[str]
    added: list[str]
    removed: list[str]
    feed: str | None
    slots: str | None
    borders: str | None
    table_schema: str
    schema: T.StructType = field(init=False)

    def __post_init__(self):
        self.schema = T.StructType.fromJson(json.loads(self.table_schema))


def snapshot_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per version: number, time, rows, note and what it added and removed."""
    try:
        log = spark.read.schema(LOG_SCHEMA).json(f"{path}/log", pathGlobFilter="v=*.json")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)
    return log


def _hadoop(spark: SparkSession, path: str):
    """The file system of ``path`` and a function from text to its paths."""
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), to_path


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Versions by the names of their log files."""
    files, to_path = _hadoop(spark, path)
    found = files.globStatus(to_path(f"{path}/log/v=*.json")) or []
    return sorted(int(s.getPath().getName()[2:-5]) for s in found)


def versions(spark: SparkSession, path: str, start: int, end: int | None = None) -> dict[int, Version]:
    """The versions ``start`` .. ``end`` that exist, with all their folders."""
    known = [n for n in _numbers(spark, path) if n >= start and (end is None or n <= end)]
    if not known:
        return {}
    first = max(1, known[0] - (known[0] - 1) % FULL_EVERY)
    files = [f"{path}/log/v={n}.json" for n in range(first, known[-1] + 1)]
    out, folders = {}, []
    for e in sorted(spark.read.schema(LOG_SCHEMA).json(files).collect(), key=lambda e: e.version):
        gone = set(e.removed)
        folders = list(e.folders) if e.folders is not None else [f for f in folders if f not in gone] + e.added
        if e.version >= start:
            out[e.version] = Version(e.version, e.rows, e.note, folders, e.added, e.removed, e.feed, e.slots, e.borders, e.table_schema)
    return out


def _entry(spark: SparkSession, path: str) -> Version | None:
    known = _numbers(spark, path)
    return versions(spark, path, known[-1])[known[-1]] if known else None


def last_version(spark: SparkSession, path: str) -> Version | None:
    """The latest version with its note, rows and folders; None before the first."""
    return _entry(spark, path)


def latest_version(spark: SparkSession, path: str) -> int | None:
    return max(_numbers(spark, path), default=None)


def _commit(spark: SparkSession, path: str, entry: Version, as_of: datetime | None) -> None:
    """Put the log file of a version in place, unless another writer did."""
    version, when = entry.version, as_of or datetime.now(timezone.utc)
    full = entry.folders if version % FULL_EVERY == 1 or len(entry.folders) <= FEW else None
    row = (
        version, when, entry.rows, entry.note, full, entry.added, entry.removed, entry.feed, entry.slots,
        entry.borders, entry.table_schema,
    )
    temporary = f"{path}/log/_new-{uuid.uuid4().hex}"
    spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.json(temporary)
    files, to_path = _hadoop(spark, path)
    part = next(s.getPath() for s in files.globStatus(to_path(f"{temporary}/part-*.json")))
    fs = spark._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        # Without the overwrite option a rename onto a file fails.
        context.rename(part, to_path(f"{path}/log/v={version}.json"), none)
    except Py4JJavaError as e:
        if "AlreadyExists" not in str(e.java_exception):
            raise
        raise ValueError(f"another writer has stored version {version} of {path}") from None
    finally:
        files.delete(to_path(temporary), True)


def write_snapshot(
    df: DataFrame,
    path: str,
    note: str = "replace",
    cluster_by: Sequence[str] = (),
    files: int | None = None,
    partition_by: Sequence[str] = (),
    as_of: datetime | None = None,
    keep: bool = False,
) -> int:
    """Write the next version of the table and return its number.

    With ``keep`` the version also holds the rows of the version before it.
    The rows are counted while they are written. Give either ``cluster_by`` with
    ``files`` or ``partition_by``.
    """
    if cluster_by and partition_by:
        raise ValueError("a table is clustered or partitioned, not both")
    spark = df.sparkSession
    last = _entry(spark, path)
    version = 1 if last is None else last.version + 1
    schema, kept = df.schema, keep and last is not None
    if kept:
        schema = last.schema
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    if cluster_by and files:
        df = cluster(df, cluster_by, files)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    folder = f"data/{version}-{uuid.uuid4().hex}"
    writer.parquet(f"{path}/{folder}")
    removed = [] if kept or last is None else last.folders
    folders = [*last.folders, folder] if kept else [folder]
    rows = seen.get["rows"] + (last.rows if kept else 0)
    _commit(spark, path, Version(version, rows, note, folders, [folder], removed, None, None, None, schema.json()), as_of)
    return version


def replace_slots(
    df: DataFrame,
    path: str,
    slots: Slots,
    touched: Iterable[int] | None = None,
    note: str = "load",
    sort_by: Sequence[str] = (),
    cells: int = 1,
    as_of: datetime | None = None,
    keep: bool = False,
    same_rows: bool = False,
) -> int:
    """Next version: the rows of ``df`` in place of those of the ``touched`` slots.

    The other slots keep their folders, which are neither read nor written. With
    ``touched`` None all slots are replaced; a row outside of the touched slots
    fails the job. ``df`` may be tagged (:mod:`tidemark.operators.tagged`): its
    changed rows are then written in the same job as the version's change feed,
    and a load that changed nothing leaves no version behind. With ``keep`` the
    rows are added to those of their slots, whose folders stay as they are.

    Rows are sorted by ``sort_by`` inside a slot. With ``cells`` above 1 a slot
    is cut into about so many files, along a curve through the ``sort_by``
    columns whose borders are found at the first load and kept in the log. The
    exchange needs no sample of the rows; adaptive execution splits what is large
    and joins what is small. ``same_rows`` says that only the layout changes.
    """
    spark, last = df.sparkSession, _entry(df.sparkSession, path)
    version = 1 if last is None else last.version + 1
    if last is not None and last.slots != str(slots):
        raise ValueError(f"{path} is dealt by {last.slots}, not by {slots}")
    tagged = OUT in df.columns
    schema = T.StructType([f for f in df.schema if f.name not in (OUT, CHANGE)]) if last is None else last.schema
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    marks = [F.col(OUT), F.col(CHANGE)] if tagged else [F.lit(STATE).alias(OUT), F.lit(None).cast("string").alias(CHANGE)]
    rows = df.select(*columns, *marks, slots.of(schema).alias(_SLOT))
    if touched is not None:
        touched = set(touched)
        inside = F.col(_SLOT).isin(*touched) if touched else F.lit(False)
        outside = F.raise_error(F.lit(f"a row of {path} lies outside of the touched slots")).cast("boolean")
        rows = rows.filter(F.when(inside, True).otherwise(outside))
    borders = None
    if cells > 1:
        if last is not None:
            borders = Borders.load(last.borders)
        else:
            state = df.filter(F.col(OUT) == STATE) if tagged else df
            borders = find_borders(state, sort_by, cells)
        rows = rows.withColumn(_Z, borders.key(schema)).withColumn(_CELL, borders.cell(F.col(_Z), cells))
        rows = rows.hint("rebalance", OUT, _SLOT, _CELL).sortWithinPartitions(OUT, _SLOT, _Z, *sort_by).drop(_Z, _CELL)
    else:
        rows = rows.hint("rebalance", OUT, _SLOT).sortWithinPartitions(OUT, _SLOT, *sort_by)
    seen, folder = Observation(), f"data/{version}-{uuid.uuid4().hex}"
    told = [F.count(F.when(F.col(OUT) == o, 1)).alias(o) for o in (STATE, FEED)]
    with released(spark):
        rows.observe(seen, *told).write.partitionBy(OUT, _SLOT).parquet(f"{path}/{folder}")
    files, to_path = _hadoop(spark, path)
    if last is not None and (tagged and not seen.get[FEED] or keep and not seen.get[STATE]):
        files.delete(to_path(f"{path}/{folder}"), True)
        return last.version
    leaves = files.globStatus(to_path(f"{path}/{folder}/{OUT}={STATE}/{_SLOT}=*")) or []
    added = sorted(f"{folder}/{OUT}={STATE}/{s.getPath().getName()}" for s in leaves)
    old = [] if last is None else last.folders
    removed = [] if keep else [f for f in old if touched is None or slot_of(f) in touched]
    count = seen.get[STATE]
    if last is not None:
        # Counts of whole files come from their footers.
        count += last.rows - (_folders(spark, path, last.schema, removed).count() if removed else 0)
    gone = set(removed)
    feed = "" if same_rows else None if not tagged else f"{folder}/{OUT}={FEED}" if seen.get[FEED] else ""
    entry = Version(
        version, count, note, [f for f in old if f not in gone] + added, added, removed, feed, str(slots),
        None if borders is None else borders.dump(), schema.json(),
    )
    _commit(spark, path, entry, as_of)
    return version


def append_slots(df: DataFrame, path: str, slots: Slots, note: str = "append", **layout) -> int:
    """Next version: the latest plus the rows of ``df``, laid out by the borders of
    the first load. No file that is there is read or written. Slots that have
    gathered many folders are put in order by :func:`compact_slots`."""
    return replace_slots(df, path, slots, None, note, keep=True, **layout)


def compact_slots(spark: SparkSession, path: str, slots: Slots, most: int = 8, **layout) -> int | None:
    """Rewrite the slots that consist of more than ``most`` folders, and no other;
    None when there are none. The rows stay the same, which the version says by an
    empty change feed."""
    entry, held = _entry(spark, path), {}
    for f in entry.folders if entry else ():
        held[slot_of(f)] = held.get(slot_of(f), 0) + 1
    many = sorted(s for s, n in held.items() if n > most)
    if not many:
        return None
    return replace_slots(read_snapshot(spark, path, slots=many), path, slots, many, "compact", same_rows=True, **layout)


def slot_of(folder: str) -> int:
    return int(folder.rsplit(f"{_SLOT}=", 1)[1])


def changed_slots(spark: SparkSession, path: str, start: int, end: int | None = None) -> list[int]:
    """Slots whose rows the versions ``start`` .. ``end`` wrote anew, from the log alone."""
    out = set()
    for v in versions(spark, path, start, end).values():
        # A version with an empty feed has the rows of the one before.
        if v.feed == "":
            continue
        out |= {slot_of(f) for f in (*v.added, *v.removed)}
    return sorted(out)


def read_snapshot(
    spark: SparkSession, path: str, version: int | None = None, slots: Iterable[int] | None = None
) -> DataFrame:
    """A version of the table, the latest by default, or just some of its slots."""
    entry = _entry(spark, path) if version is None else versions(spark, path, version, version).get(version)
    if entry is None:
        raise ValueError(f"{path} has no version {'at all' if version is None else version}")
    folders = entry.folders
    if slots is not None:
        wanted = set(slots)
        folders = [f for f in folders if slot_of(f) in wanted]
    return _folders(spark, path, entry.schema, folders)


def read_versions(spark: SparkSession, path: str, start: int, end: int | None = None) -> dict[int, DataFrame]:
    """Versions ``start`` - 1 .. ``end`` by number, as a change feed needs them."""
    return {n: _folders(spark, path, v.schema, v.folders) for n, v in versions(spark, path, start - 1, end).items()}


def read_differences(spark: SparkSession, path: str, old: Version | None, now: Version) -> tuple[DataFrame, DataFrame]:
    """The rows of the folders that only the older version has, and those of the
    folders that only the newer one has.

    Folders never change, so a row key with a change is in one of these. After
    an append they are none and the new rows.
    """
    before, after = set(old.folders if old else ()), set(now.folders)
    schema = (old or now).schema
    return (
        _folders(spark, path, schema, sorted(before - after)),
        _folders(spark, path, now.schema, sorted(after - before)),
    )


def read_feed(spark: SparkSession, path: str, entry: Version) -> DataFrame:
    """The changed rows that a version's load wrote, with their ``_change_type``."""
    schema = T.StructType([*entry.schema, T.StructField(CHANGE, T.StringType())])
    return _folders(spark, path, schema, [entry.feed] if entry.feed else [])


def _folders(spark: SparkSession, path: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    # A slot's folder name is no column: the table's own columns say all.
    one = spark.read.schema(schema)
    if any(f"{_SLOT}=" in f or f"{OUT}=" in f for f in folders):
        one = one.option("recursiveFileLookup", "true")
    return one.parquet(*[f"{path}/{f}" for f in folders])


def append(df: DataFrame, path: str, note: str = "append", **layout) -> int:
    """Next version = latest version plus the rows of ``df``."""
    return write_snapshot(df, path, note, keep=True, **layout)


def replace(df: DataFrame, path: str, note: str = "replace", **layout) -> int:
    """Next version = ``df``, whatever the schema was before."""
    return write_snapshot(df, path, note, **layout)
