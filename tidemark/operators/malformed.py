"""Raw rows that do not fit their table, told apart with the reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.conform import ColSpec
from tidemark.sources.delimited import LINE

REASON, KEPT, CONTENT = "reason", "kept", "content"
WRONG_FIELDS = "number of fields"


def malformed(raw: DataFrame, spec: Sequence[ColSpec], keys: Sequence[str]) -> DataFrame:
    """One row per malformed raw row: its ``content``, the first ``reason``, and
    whether a load keeps the row.

    ``raw`` is text read with its lines. A line with too few or too many fields
    (its values may be shifted) and a row without a readable key are not kept; a
    row whose other values do not fit their type is, with NULL in their place. One
    pass over the rows, without a shuffle.
    """
    given = [c for c in raw.columns if c != LINE]
    value = {c.name: c.column() for c in spec}
    reasons = [F.when(F.col(LINE).isNotNull(), WRONG_FIELDS)]
    reasons += [F.when(value[k].isNull(), f"no {k}") for k in keys]
    reasons += [
        F.when(F.col(f"`{c.source}`").isNotNull() & value[c.name].isNull(), f"{c.name} is no {c.kind}")
        for c in spec
        if c.kind != "string" and c.name not in keys
    ]
    held = F.coalesce(F.col(LINE), F.to_json(F.struct(*[F.col(f"`{c}`") for c in given])))
    lost = F.col(REASON).isin(WRONG_FIELDS, *[f"no {k}" for k in keys])
    return (
        raw.select(held.alias(CONTENT), F.coalesce(*reasons).alias(REASON))
        .filter(F.col(REASON).isNotNull())
        .withColumn(KEPT, ~lost)
    )


def well_formed(raw: DataFrame) -> DataFrame:
    """The rows with the right number of fields, without their lines."""
    return raw.filter(F.col(LINE).isNull()).drop(LINE)
