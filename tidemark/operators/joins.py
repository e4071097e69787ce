"""Dimension look-ups.

No join here carries a broadcast hint. Spark broadcasts a side when its
statistics or its measured shuffle size allow it, and splits a hot key of the
fact side otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.operators.scd2 import current


@dataclass(frozen=True)
class DimSpec:
    """A look-up of one star join.

    ``on`` maps fact columns to dimension columns; ``add`` maps new columns to
    dimension columns. With ``required`` fact rows without a match are dropped;
    with ``current_only`` just the current rows of the dimension take part.
    """

    dim: DataFrame
    on: Mapping[str, str]
    add: Mapping[str, str] = field(default_factory=dict)
    required: bool = False
    current_only: bool = False


class LookUps:
    """What the look-ups of star joins did to their rows, counted in passing.

    The counts are there once the joined rows were computed by an action that
    succeeded; asking earlier waits for it.
    """

    def __init__(self):
        self._seen: list[tuple[str, bool, Observation, Observation | str]] = []

    def told(self) -> dict[str, dict[str, int]]:
        """By the columns looked up: rows ``unmatched``, those ``dropped`` for it,
        and those that came out more often than they went in (``multiplied``)."""
        out, left = {}, {}
        for name, required, after, before in self._seen:
            met = after.get
            came = left[before] if isinstance(before, str) else before.get["rows"]
            out[name] = {
                "unmatched": met["unmatched"],
                "dropped": met["unmatched"] if required else 0,
                "multiplied": met["rows"] - came,
            }
            left[name] = met["rows"] - out[name]["dropped"]
        return out

    def check(self) -> dict[str, dict[str, int]]:
        """The counts; an error if a look-up holds a key twice."""
        told = self.told()
        twice = {name: t["multiplied"] for name, t in told.items() if t["multiplied"]}
        if twice:
            raise ValueError(f"a look-up holds keys more than once; rows too many by column: {twice}")
        return told


def star_join(fact: DataFrame, dims: Sequence[DimSpec], report: LookUps | None = None) -> DataFrame:
    """Join the dimensions one after the other; a later one may use columns
    that an earlier one added. ``report`` counts what each of them does, inside
    the pass and without a shuffle of its own."""
    helpers: list[str] = []
    before: Observation | str = Observation()
    if report is not None:
        fact = fact.observe(before, F.count(F.lit(1)).alias("rows"))
    for n, spec in enumerate(dims):
        dim = current(spec.dim) if spec.current_only else spec.dim
        names = {f"_on_{n}_{i}": d for i, d in enumerate(spec.on.values())}
        keyed = dim.select(*[F.col(d).alias(name) for name, d in [*names.items(), *spec.add.items()]])
        test = [F.col(f) == F.col(name) for f, name in zip(spec.on, names)]
        if report is None:
            fact = fact.join(keyed, test, "inner" if spec.required else "left")
        else:
            hit, name, after = F.col(f"_hit_{n}"), ", ".join(spec.on), Observation()
            fact = fact.join(keyed.withColumn(f"_hit_{n}", F.lit(True)), test, "left").observe(
                after, F.count(F.lit(1)).alias("rows"), F.count(F.when(hit.isNull(), 1)).alias("unmatched")
            )
            if spec.required:
                fact = fact.filter(hit.isNotNull())
            report._seen.append((name, spec.required, after, before))
            helpers.append(f"_hit_{n}")
            before = name
        helpers += names
    return fact.drop(*helpers)


def left_current(
    df: DataFrame, dim: DataFrame, on: Mapping[str, str], add: Mapping[str, str]
) -> DataFrame:
    """Left join to the current rows of a dimension; unmatched rows stay."""
    return star_join(df, [DimSpec(dim, on, add, current_only=True)])


def translate(
    df: DataFrame, col: str, lookup: DataFrame, value: str, into: Mapping[str, str]
) -> DataFrame:
    """Translate ``col`` through ``lookup``; a value without an entry is kept.

    ``into`` maps new columns to lookup columns.
    """
    found = star_join(
        df, [DimSpec(lookup, {col: value}, {f"_t_{name}": c for name, c in into.items()})]
    )
    kept: dict[str, Column] = {name: F.coalesce(f"_t_{name}", col) for name in into}
    return found.withColumns(kept).drop(*[f"_t_{name}" for name in into])
