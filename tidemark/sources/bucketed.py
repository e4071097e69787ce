"""Tables written in buckets of their key, so that a load need not shuffle them.

Bucket files carry their number, and a catalog entry tells Spark how rows were
dealt. No metastore is needed: the entry is made for the read and dropped again.
A type 2 load over a bucketed target (``scd2_apply(buckets=...)``) shuffles its
batch alone: the joins, the windows and the write of the next state all find the
target's rows in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T


def write_bucketed(
    df: DataFrame, path: str, keys: Sequence[str], buckets: int, sort_by: Sequence[str] = (), dealt: bool = False
) -> None:
    """Write ``df`` to a new folder in ``buckets`` buckets by a hash of ``keys``,
    sorted by ``sort_by`` (default: the keys) inside each.

    ``dealt`` says that the rows lie in as many partitions by ``keys`` already, as
    the next state of a bucketed target does; they are not exchanged again.
    """
    name = _name()
    rows = df if dealt else df.repartition(buckets, *keys)
    rows.write.bucketBy(buckets, *keys).sortBy(*(sort_by or keys)).option("path", path).saveAsTable(name)
    # The rows stay: the table lies outside of the warehouse.
    df.sparkSession.sql(f"DROP TABLE {name}")


def read_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int, sort_by: Sequence[str] = ()
) -> DataFrame:
    """The rows of a folder of :func:`write_bucketed`, which Spark knows to be dealt by ``keys``."""
    name = _name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    quoted = [", ".join(f"`{c}`" for c in cols) for cols in (keys, sort_by or keys)]
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{path}') "
        f"CLUSTERED BY ({quoted[0]}) SORTED BY ({quoted[1]}) INTO {buckets} BUCKETS"
    )
    found = spark.table(name)
    # The frame knows its folder and its buckets; the entry has served.
    spark.sql(f"DROP TABLE {name}")
    return found


def _name() -> str:
    return f"tidemark_bucketed_{uuid.uuid4().hex}"
