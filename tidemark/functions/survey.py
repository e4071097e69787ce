"""Fields of an XML document held in a text column."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import xml_or_null

_BAD = "_malformed"


def survey_fields(
    df: DataFrame,
    xml_col: str,
    fields: dict[str, tuple[str, str]],
    blank_as_null: bool = True,
    bad_col: str | None = None,
) -> DataFrame:
    """Add one column per entry of ``fields``: name -> (path, type), the paths
    of one form: ``//Root/Node``.

    A document is parsed once per row, whatever the number of fields, and
    without its namespaces. Text that is no XML gives NULL, and so do malformed
    documents, another root and values that do not fit the type. ``bad_col``
    names a column that marks the malformed documents, to be counted. A missing
    node is NULL, or the empty string with ``blank_as_null=False``.
    """
    steps = [re.fullmatch(r"//(\w+)/(\w+)", path) for path, _ in fields.values()]
    if not all(steps) or len({m[1] for m in steps}) != 1:
        raise ValueError("paths must read //Root/Node, with one root")
    root, nodes = steps[0][1], [m[2] for m in steps]
    xml = xml_or_null(F.col(xml_col))
    schema = ", ".join([*(f"`{n}` string" for n in dict.fromkeys(nodes)), f"{_BAD} string"])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, "ignoreNamespace": "true"}
    found = df.withColumn("_parsed", F.from_xml(xml, schema, options))
    bad = F.col(f"_parsed.{_BAD}").isNotNull()
    starts = rf"^\s*(<[?!][^>]*>\s*)*<(\w+:)?{root}[\s/>]"
    usable = xml.isNotNull() & ~bad & F.col(xml_col).rlike(starts)
    cols = {} if bad_col is None else {bad_col: F.coalesce(bad, F.lit(False))}
    for (name, (_, kind)), node in zip(fields.items(), nodes, strict=True):
        text = F.coalesce(F.col(f"_parsed.{node}"), F.lit(""))
        cols[name] = _typed(F.when(usable, F.nullif(text, F.lit("")) if blank_as_null else text), kind)
    return found.withColumns(cols).drop("_parsed")


def _typed(text: Column, kind: str) -> Column:
    if kind == "string":
        return text
    if kind == "date":
        return F.regexp_replace(text, "Z$", "").try_cast("date")
    return text.try_cast(kind)
