"""Mixing sources to target weights with Pfair windows.

Unit i of a source of weight w may start at slot floor(i/w) and must be placed
before slot ceil((i+1)/w); earliest deadline first then keeps every source less
than one unit from its target. One such run over all slots would be sequential,
so the rule is applied twice: to periods of many slots, which says how many units
of each source a period takes (``per_period``), and to the slots of a period
(``one_period``), each period being a row of its own that any task can lay out.
Each level may be off by less than one unit, so a unit is half a block: after any
number of slots no source is a whole block ahead of or behind its target. Weights
are exact fractions and are never rounded.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from math import isqrt, lcm

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

BLOCK = 16
PERIOD = 10_000
# The sources are listed on the driver; a mix of more is refused.
MAX_SOURCES = 100_000

_LAST = (1 << 63) - 1


def shares(weights: dict[str, float | Fraction]) -> dict[str, int]:
    """Whole numbers in the exact proportion of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    if bad := sorted(s for s, w in exact.items() if w <= 0):
        raise ValueError(f"weights must be positive: {bad[:5]}")
    scale = lcm(*[w.denominator for w in exact.values()])
    return {s: int(w * scale) for s, w in exact.items()}


def per_period(parts: dict[str, int], length: int, period: int) -> Iterator[tuple[int, int, dict[str, tuple[int, int]]]]:
    """(first slot, slots, {source: (first unit, units)}) of each period by EDF.

    A period takes the units due by its end and then, of the next unit of each
    source, those released by then with the earliest deadlines.
    """
    whole = sum(parts.values())
    done = dict.fromkeys(parts, 0)
    for start in range(0, length, period):
        end = min(start + period, length)
        take = {s: max(p * end // whole - done[s], 0) for s, p in parts.items()}
        spare = end - start - sum(take.values())
        released = [s for s, p in parts.items() if (done[s] + take[s]) * whole < p * end]
        for s in heapq.nsmallest(spare, released, key=lambda s: (Fraction(done[s] + take[s] + 1, parts[s]), s)):
            take[s] += 1
        yield start, end - start, {s: (done[s], n) for s, n in take.items() if n}
        for s, n in take.items():
            done[s] += n


def one_period(slots: dict[str, int], resolution: int) -> list[tuple[str, int, int, int, int]]:
    """(source, unit of the period, slot, release, deadline) by EDF."""
    def window(s: str, j: int) -> tuple[int, int]:
        return j * resolution // slots[s], -(-(j + 1) * resolution // slots[s])

    waiting = [(window(s, 0)[0], window(s, 0)[1], s, 0) for s in sorted(slots)]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int, int]] = []
    out = []
    for t in range(resolution):
        while waiting and waiting[0][0] <= t:
            r, d, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (d, s, j, r))
        d, s, j, r = heapq.heappop(ready)
        assert t < d, "a deadline was missed"
        out.append((s, j, t, r, d))
        if j + 1 < slots[s]:
            heapq.heappush(waiting, (*window(s, j + 1), s, j + 1))
    return out


def mix_sources(
    docs: DataFrame,
    weights: dict[str | None, float | Fraction] | None = None,
    source: str = "source",
    key: str = "doc_id",
    carry: tuple[str, ...] = (),
    block: int = BLOCK,
    period: int = PERIOD,
    temperature: float = 0.5,
    seed: int = 7,
) -> DataFrame:
    """Every row once, with its place: key, source, ``block_no`` (from 0 within
    the source), ``block_pos``, ``release``, ``deadline``, ``slot`` and
    ``on_target``, plus the ``carry`` columns. Reading by (slot, block_pos) gives
    the mix. A slot holds half a block; slots have no gaps.

    Default weights are counts to the power ``temperature``. ``on_target`` marks
    the rows placed before a source runs out: up to there no source is a block off
    its exact target, so that each slot lies from ``release`` up to ``deadline``,
    the slots at which its unit would be a block ahead or behind. The rest is
    mixed in the proportion of what is left of each source.

    NULL is a source of its own; a listed source without rows gets no weight, one
    without a weight, or with one that is not positive, raises an error. Rows of a
    source are dealt in a fixed pseudo-random order; repeated rows and rows of one
    or no key each get a place. Texts are not read but carried, so their length
    does not matter. An empty table gives an empty result.
    """
    if block < 2 or block % 2:
        raise ValueError("a block holds an even number of rows")
    half = block // 2
    spark = docs.sparkSession
    src = F.coalesce(F.concat(F.lit("s:"), F.col(f"`{source}`").cast("string")), F.lit("null"))
    carried = [c for c in carry if c not in (key, source)]
    content = [c for c in docs.columns if c == "text"]
    named = docs.select(
        F.col(f"`{key}`").alias("_key"), F.col(f"`{source}`").alias("_source"), src.alias("_src"),
        F.xxhash64(F.lit(seed), F.col(f"`{key}`")).alias("_order"),
        (F.xxhash64(*content) if content else F.lit(0).cast("long")).alias("_tie"),
        *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carried)],
    )
    # A source is ranked in parts, whose number grows with the rows, so that the
    # largest source is not one task's work.
    total = docs.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // 50_000)
    named = named.withColumn("_part", F.pmod("_order", F.lit(parts)))
    sizes = named.groupBy("_src", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_src").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")

    counts = dict(sizes.groupBy("_src").agg(F.sum("_n")).limit(MAX_SOURCES + 1).collect())
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if weights is None:
        weighed = {s: n**temperature for s, n in counts.items()}
    else:
        given = {"null" if s is None else f"s:{s}": w for s, w in weights.items()}
        if missing := sorted(set(counts) - set(given)):
            raise ValueError(f"no weight for {missing[:5]}")
        weighed = {s: given[s] for s in counts}
    names = sorted(counts)
    left = {s: -(-counts[s] // half) for s in names}
    # The driver holds one row per period; their number grows with the root of the slots.
    period = max(period, isqrt(sum(left.values())), 4 * len(names))
    plans, rows, placed, base = [], [], dict.fromkeys(names, 0), 0
    targets = shares({s: weighed[s] for s in names}) if names else {}
    horizon = min((left[s] * sum(targets.values()) // p for s, p in targets.items()), default=0)
    for parts, length in ((targets, horizon), (None, sum(left.values()) - horizon)):
        if not length:
            continue
        parts = parts or {s: n - placed[s] for s, n in left.items() if n > placed[s]}
        plans.append((base, sum(parts.values()), parts, dict(placed)))
        for start, slots, taken in per_period(parts, length, period):
            rows.append((len(plans) - 1, start, slots, list(taken), *map(list, zip(*taken.values()))))
            for s, (_, n) in taken.items():
                placed[s] += n
        base += length
    periods = spark.createDataFrame(
        rows, "plan int, start long, slots long, sources array<string>, first array<long>, units array<long>"
    )

    def lay_out(batches):
        for batch in batches:
            for row in batch.itertuples():
                base, whole, parts, before = plans[row.plan]
                first = dict(zip(row.sources, map(int, row.first)))
                units = dict(zip(row.sources, map(int, row.units)))
                out = []
                for s, j, t, _, _ in one_period(units, row.slots):
                    i = first[s] + j
                    release = base + max((i - 1) * whole // parts[s], 0)
                    deadline = min(base - (-(i + 2) * whole // parts[s]), _LAST)
                    out.append((s, before[s] + i, base + row.start + t, release, deadline))
                yield pd.DataFrame(out, columns=["_src", "_unit", "slot", "release", "deadline"])

    table = periods.mapInPandas(lay_out, "_src string, _unit long, slot long, release long, deadline long")

    order = Window.partitionBy("_src", "_part").orderBy("_order", "_key", "_tie")
    ranked = (
        named.withColumn("_rank", F.row_number().over(order))
        .join(starts, ["_src", "_part"])
        .withColumn("_rank", F.col("_rank") - 1 + F.col("_before"))
        .withColumn("_unit", F.expr(f"_rank div {half}"))
    )
    # A unit holds half a block of rows, so no key of this join is a hot one.
    return ranked.join(table, ["_src", "_unit"]).select(
        F.col("_key").alias(key), F.col("_source").alias(source),
        F.expr(f"_rank div {block}").alias("block_no"), (F.col("_rank") % block).alias("block_pos"),
        "release", "deadline", "slot", (F.col("slot") < horizon).alias("on_target"),
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carried)],
    )
