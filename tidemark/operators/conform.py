"""Cast and rename raw columns by a declarative list."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.money import money
from tidemark.operators.scd2 import LOAD_COL, load_stamp


@dataclass(frozen=True)
class ColSpec:
    """``source`` cast to ``kind`` under the name ``name``; ``abs`` for amounts
    that must not be negative."""

    source: str
    name: str
    kind: str
    abs: bool = False

    def column(self) -> Column:
        raw = F.col(f"`{self.source}`")
        value = money(raw) if self.abs else raw.try_cast(self.kind)
        return value.alias(self.name)


def conform(df: DataFrame, spec: Sequence[ColSpec], keys: Sequence[str] = ()) -> DataFrame:
    """Select, cast and rename; columns not listed are dropped, and so are rows
    with a NULL in one of ``keys``. Text that does not fit its type is NULL."""
    out = df.select(*[c.column() for c in spec])
    return out.na.drop(subset=list(keys)) if keys else out


def with_load_ts(
    df: DataFrame, name: str = LOAD_COL, as_of: datetime | str | None = None
) -> DataFrame:
    return df.withColumn(name, load_stamp(as_of))
