"""Hand a table over to a serving engine as plain parquet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.sources.snapshots import last_version, read_snapshot, replace


def as_serving(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """The columns and types the serving table declares. A value that does not
    fit its declared type becomes NULL; :func:`publish` counts these."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in _struct(schema)])


def _struct(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


@dataclass(frozen=True)
class Published:
    """What an export wrote: its version, rows, the folder a serving table points
    at, and how many values of each column did not fit their declared type."""

    version: int
    rows: int
    location: str
    misfits: dict[str, int]


def publish(df: DataFrame, path: str, schema: str | T.StructType) -> Published:
    """Write the next version of an export. Readers keep the folder they opened;
    the new one becomes visible at once with its log entry. Misfits are counted
    while the rows are written."""
    fields, seen = _struct(schema).fields, Observation()
    lost = [F.count(F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), 1)).alias(f.name) for f in fields]
    version = replace(as_serving(df.observe(seen, *lost), schema), path, "export")
    entry = last_version(df.sparkSession, path)
    misfits = {name: n for name, n in seen.get.items() if n}
    return Published(version, entry.rows, serving_location(df.sparkSession, path), misfits)


def serving_location(spark: SparkSession, path: str) -> str:
    """The folder of the latest export, for the location of an external table."""
    return f"{path}/{last_version(spark, path).folders[0]}"


def read_published(spark: SparkSession, path: str) -> DataFrame:
    return read_snapshot(spark, path)


def export_parquet(df: DataFrame, path: str, files: int | None = None) -> int:
    """Replace the export at ``path``; prints the schema, returns the rows.

    The rows are counted while they are written, not by a second run.
    """
    df.printSchema()
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    (out.coalesce(files) if files else out).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def read_export(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
