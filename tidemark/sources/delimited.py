"""Delimited text without a header; columns bind by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

CONTROL_A = "\x01"
NULL_WORD = "null"
LINE = "_line"


def all_string(schema: str | T.StructType) -> T.StructType:
    """The same columns, all text, for files that are cast later."""
    if isinstance(schema, str):
        names = [column.split(" ")[0] for column in schema.split(", ")]
    else:
        names = schema.names
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType,
    sep: str = ",",
    null_value: str = NULL_WORD,
    lines: bool = False,
) -> DataFrame:
    """Read text files as ``schema``. Control-A files are taken without quotes,
    since their fields hold XML with quotes and commas.

    With ``lines`` a column ``LINE`` holds the text of each line that has too few
    or too many fields or a value that ``schema`` can not take, and NULL for others.
    """
    if lines:
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = T.StructType([*fields, T.StructField(LINE, T.StringType())])
    reader = spark.read.schema(schema).option("sep", sep).option("nullValue", null_value)
    if lines:
        # All fields are parsed, whichever are asked for: else no line is too short.
        reader = reader.option("columnNameOfCorruptRecord", LINE).option("columnPruning", "false")
    if sep == CONTROL_A:
        reader = reader.option("quote", "")
    return reader.csv(path)


def write_delimited(
    df: DataFrame, path: str, sep: str = ",", null_value: str = NULL_WORD, mode: str = "errorifexists"
) -> None:
    writer = df.write.mode(mode).option("sep", sep).option("nullValue", null_value)
    if sep == CONTROL_A:
        writer = writer.option("quote", "").option("escapeQuotes", "false")
    writer.csv(path)
