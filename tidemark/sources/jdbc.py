"""Bulk extract of a database table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.text import strip_delims
from tidemark.sources.delimited import write_delimited


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    num_partitions: int = 1,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read a table or a parenthesised query, in ``num_partitions`` ranges of
    ``column``. Credentials come in ``properties``, from the caller."""
    if num_partitions == 1:
        return spark.read.jdbc(url, table, properties=properties or {})
    if column is None or lower is None or upper is None:
        raise ValueError("several partitions need a column with its lower and upper bound")
    return spark.read.jdbc(url, table, column, lower, upper, num_partitions, properties=properties or {})


def extract(df: DataFrame, path: str, sep: str = ",", strip: Sequence[str] = ()) -> None:
    """Replace the text files at ``path``; line breaks and delimiters are taken
    out of the columns in ``strip``."""
    write_delimited(strip_delims(df, strip) if strip else df, path, sep, mode="overwrite")
