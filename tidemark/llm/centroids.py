"""Exact integer k-means, with distances bounded from below in rotated coordinates.

Vectors are rotated to their principal axes once. A row keeps its leading
rotated coordinates and the norm of the rest. For a row and a centroid, the
squared distance of the leading coordinates plus the squared difference of the
norms is at most their true squared distance, whatever the rotation, so the axes
only decide how many centroids the bound rules out. What it leaves is compared
in whole numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.session import stage

# Leading coordinates that a row keeps.
LEAD = 16
# Components below this have squared distances that fit 64 bits; larger ones are
# compared as Python integers.
NARROW = 1 << 27
# Components beyond this say nothing more to the axes.
_AXES_REACH = float(1 << 40)
# The kept coordinates are 32-bit floats: their error is below 6e-8 of the norm.
_SLACK = 1e-6
# (row, centroid) pairs looked at together.
_PAIRS = 80_000


def integers(values: np.ndarray, scale: int = 256) -> np.ndarray:
    """``floor(scale * x)``: 64-bit when all are narrow, else Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(scale))
    if not scaled.size or np.abs(scaled).max() < NARROW:
        return scaled.astype(np.int64)
    whole = [math.floor(x) * scale if abs(x) >= 2.0**60 else math.floor(x * scale) for x in values.ravel().tolist()]
    out = np.empty(len(whole), object)
    out[:] = whole
    return out.reshape(values.shape)


def _floats(whole: np.ndarray) -> np.ndarray:
    """Whole numbers as floats; those out of reach become infinite."""
    if whole.dtype != object:
        return whole.astype(np.float64)
    near = [float(x) if abs(x) < 10**300 else (math.inf if x > 0 else -math.inf) for x in whole.ravel().tolist()]
    return np.array(near, np.float64).reshape(whole.shape)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, size)


class Centroids:
    """Whole-number centroids with their places in rotated coordinates."""

    def __init__(self, values: list[list[int]], axes: np.ndarray, lead: int):
        self.values = np.empty((len(values), len(axes)), object)
        for i, v in enumerate(values):
            self.values[i] = v
        self.narrow = np.array([max(map(abs, v), default=0) < NARROW for v in values], bool)
        self.small = np.where(self.narrow[:, None], self.values, 0).astype(np.int64)
        with np.errstate(all="ignore"):
            rotated = _floats(self.values) @ axes
        self.lead, self.rest = rotated[:, :lead], np.linalg.norm(rotated[:, lead:], axis=1)
        self.norm = np.linalg.norm(rotated, axis=1)

    def exact(self, rows: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Squared distances of pairs; Python integers if any of them is wide."""
        if rows.dtype != object and self.narrow[which].all():
            apart = rows - self.small[which]
            return np.einsum("ij,ij->i", apart, apart)
        apart = rows.astype(object) - self.values[which]
        return (apart * apart).sum(axis=1)

    def nearest(self, rows: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid (the smaller number of equals), its squared distance,
        and the number of pairs that were compared in whole numbers."""
        with np.errstate(all="ignore"):
            lead, rest = lead.astype(np.float64), rest.astype(np.float64)
            bound = (lead * lead).sum(axis=1)[:, None] + (self.lead * self.lead).sum(axis=1) - 2 * lead @ self.lead.T
            bound = np.maximum(bound, 0) + (rest[:, None] - self.rest) ** 2
            bound = np.sqrt(bound)
            start = np.argmin(bound, axis=1)
            reach = np.sqrt(_floats(self.exact(rows, start)))
            norm = np.linalg.norm(_floats(rows), axis=1)
            limit = reach[:, None] * (1 + 1e-12) + _SLACK * (norm[:, None] + self.norm)
            # Written so that an undefined bound rules nothing out.
            left = ~(bound > limit)
        left[np.arange(len(rows)), start] = True
        row, which = np.nonzero(left)
        apart = self.exact(rows[row], which)
        first = np.searchsorted(row, np.arange(len(rows)))
        best = np.minimum.reduceat(apart, first) if len(rows) else apart
        hit = np.flatnonzero(apart == best[row])
        # The first hit of each row has the smallest centroid number.
        winner = hit[np.searchsorted(row[hit], np.arange(len(rows)))]
        return which[winner], best, len(row)


def _assigned(batch: pa.RecordBatch, given: Centroids, size: int, lead: int) -> Iterator[tuple]:
    """(rows, whole numbers, cluster, distance) of a batch, block by block."""
    values = _matrix(batch.column("vector"), size)
    near, rest = _matrix(batch.column("lead"), lead), np.asarray(batch.column("rest"), np.float64)
    step = max(1, _PAIRS // max(len(given.values), 1))
    for at in range(0, len(values), step):
        part = slice(at, at + step)
        rows = integers(values[part])
        cluster, distance, _ = given.nearest(rows, near[part], rest[part])
        yield part, rows, cluster, distance


def _axes(kept: DataFrame, size: int) -> np.ndarray:
    """Principal axes of all rows, the widest first, as columns.

    A partition sums its moments, some 64 tasks sum those of the partitions, and
    the driver what these leave: a bounded number of small matrices.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            values = np.clip(_matrix(batch.column(0), size) * 256.0, -_AXES_REACH, _AXES_REACH)
            wide = np.hstack([values, np.ones((len(values), 1))])
            total += wide.T @ wide
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["moments"])

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(m, np.float64) for m in table.column("moments").to_pylist())
        return pa.table({"moments": pa.array([total.tobytes()], pa.binary())})

    parts = kept.select("vector").mapInArrow(moments, "moments binary").withColumn("_to", F.pmod(F.xxhash64("moments"), F.lit(64)))
    sums = parts.groupBy("_to").applyInArrow(lambda t: added(t.select(["moments"])), "moments binary").collect()
    if not sums:
        return np.eye(size)
    total = sum(np.frombuffer(r.moments, np.float64) for r in sums).reshape(size + 1, size + 1)
    n = max(total[size, size], 1.0)
    mean = total[:size, size] / n
    _, axes = np.linalg.eigh(total[:size, :size] / n - np.outer(mean, mean))
    return axes[:, ::-1]


def _rotated(kept: DataFrame, axes: np.ndarray, size: int, lead: int) -> DataFrame:
    """The kept rows with their leading rotated coordinates and the rest's norm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore", invalid="ignore"):
                # Of the whole numbers, as these are what is compared.
                turned = np.floor(_matrix(batch.column("vector"), size) * 256.0) @ axes
                near = turned[:, :lead].astype(np.float32).ravel()
                rest = np.linalg.norm(turned[:, lead:], axis=1).astype(np.float32)
            near = pa.FixedSizeListArray.from_arrays(pa.array(near), lead).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, near, pa.array(rest)], names=["_key", "vector", "lead", "rest"])

    fields = [*kept.schema.fields, T.StructField("lead", T.ArrayType(T.FloatType())), T.StructField("rest", T.FloatType())]
    return kept.mapInArrow(run, T.StructType(fields))


def _moved(rows: DataFrame, given: Centroids, size: int, lead: int) -> dict[int, list[int]]:
    """The floored mean of every non-empty cluster.

    Each task adds up its own rows, so that a cluster of any size comes down to
    one row per task before the exchange.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(given.values), np.int64)
        total = np.zeros((len(given.values), size), object)
        for batch in batches:
            for _, whole, cluster, _ in _assigned(batch, given, size, lead):
                order = np.argsort(cluster, kind="stable")
                met, first = np.unique(cluster[order], return_index=True)
                total[met] += np.add.reduceat(whole[order], first, axis=0)
                count += np.bincount(cluster, minlength=len(count))
        met = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array(count[met]), pa.array([",".join(map(str, t)) for t in total[met]], pa.string())],
            names=["cluster", "n", "total"],
        )

    def mean(table: pa.Table) -> pa.Table:
        n, total = sum(table.column("n").to_pylist()), [0] * size
        for text in table.column("total").to_pylist():
            total = [a + int(b) for a, b in zip(total, text.split(","))]
        return pa.table({"cluster": table.column("cluster").slice(0, 1), "mean": pa.array([",".join(str(t // n) for t in total)])})

    sums = rows.mapInArrow(partial, "cluster int, n long, total string")
    found = sums.groupBy("cluster").applyInArrow(mean, "cluster int, mean string").collect()
    return {r.cluster: [int(x) for x in r["mean"].split(",")] for r in found}


def cluster_vectors(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    size: int = 64,
    k: int = 40,
    rounds: int = 5,
    lead: int = LEAD,
    watch: Callable[[int, list[list[int]]], None] | None = None,
) -> DataFrame:
    """k-means over ``floor(256 * x)`` of every vector with ``size`` finite components.

    Returns per kept row: key, ``cluster``, ``distance`` (squared), the exact sums
    ``cluster_inertia`` and ``inertia``, and ``centroid_sha256``.

    The ``k`` rows with the smallest ``sha256('2:' + key)`` start; equal keys are
    ordered by their vectors, NULL keys come last. Rows with repeated keys or
    vectors are rows of their own. A NULL vector, or one with a NULL or non-finite
    component or of another length, is left out. Fewer rows than ``k`` give fewer
    clusters, an empty table an empty result. Equal distances go to the smaller
    number. A distance or sum beyond 64 bits is NULL; the cluster is exact all the
    same. Other columns are not read. ``watch`` is told the centroids of each round.

    The rows are stored once with their rotated coordinates; a round reads them,
    exchanges one row per task and cluster, and brings ``k`` rows to the driver.
    """
    kind = table.schema[vector].dataType
    values = F.col(f"`{vector}`")
    if not isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
        values = values.cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = table.select(F.col(f"`{key}`").alias("_key"), values.alias("vector")).filter((F.size(values) == size) & ~bad)

    drawn = F.sha2(F.concat(F.lit("2:"), F.col("_key").cast("string")), 256)
    chosen = kept.select(drawn.alias("_drawn"), "vector").orderBy(F.asc_nulls_last("_drawn"), "vector").limit(k)
    starts = [integers(np.array([r.vector], np.float64))[0].tolist() for r in chosen.collect()]

    axes, lead = _axes(kept, size), min(lead, size)
    rows = stage(_rotated(kept, axes, size, lead), "rotated")
    for n in range(rounds):
        if watch:
            watch(n, starts)
        if starts:
            means = _moved(rows, Centroids(starts, axes, lead), size, lead)
            starts = [means.get(i, old) for i, old in enumerate(starts)]
    if watch:
        watch(rounds, starts)
    given = Centroids(starts, axes, lead)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, cluster, distance in _assigned(batch, given, size, lead):
                fits = [int(d) if d < 1 << 63 else None for d in distance.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_key").slice(part.start, len(cluster)), pa.array(cluster, pa.int32()), pa.array(fits, pa.int64())],
                    names=["_key", "cluster", "distance"],
                )

    fields = [kept.schema["_key"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    assigned = stage(rows.mapInArrow(final, T.StructType(fields)), "assigned")
    # One row per cluster: at most k.
    met = assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count(F.when(F.col("distance").isNull(), 1)).alias("wide")
    ).collect()
    sums = {r.cluster: None if r.wide else int(r.s) for r in met}
    whole = None if None in sums.values() else sum(sums.values())

    def long(x: int | None) -> int | None:
        return x if x is not None and x < 1 << 63 else None

    told = [
        (i, long(s), long(whole), hashlib.sha256(",".join(map(str, starts[i])).encode()).hexdigest()) for i, s in sums.items()
    ]
    facts = table.sparkSession.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        F.col("_key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
