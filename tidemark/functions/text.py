"""Text clean-up expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed patterns.
TAG_GAP = r">\s+<"
NAMESPACE = r' xmlns="[^"]*"'
IMPORT_DELIMITERS = r"[\n\r\x01]"


def norm_xml(c: Column) -> Column:
    """XML text without outer blanks and without gaps between tags; NULL -> ''."""
    return F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), TAG_GAP, "><")


def xml_or_null(c: Column) -> Column:
    """The text without default namespaces if it looks like XML, else NULL."""
    return F.when(F.trim(c).startswith("<"), F.regexp_replace(c, NAMESPACE, ""))


def strip_delims(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Remove line breaks and control-A from text columns."""
    return df.withColumns({c: F.regexp_replace(c, IMPORT_DELIMITERS, "") for c in cols})
