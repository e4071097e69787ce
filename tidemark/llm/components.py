"""Connected components of an edge table by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import stage


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _least(sym: DataFrame) -> DataFrame:
    return sym.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``label``) of every node of an edge; the label is the smallest
    node reachable. Edges are (``u``, ``v``); loops are ignored, an empty table
    gives none. Minima are combined before the shuffle and joined back, so that
    a node of very many edges is split like any skewed join key. Every round is
    written to the shared folder."""
    edges = stage(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    seen = _print(edges)
    while seen[0]:
        # Large star: every larger neighbour takes the node's least one.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = _least(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(m, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: smaller neighbours and the node itself take the least.
        m = _least(large)
        near = large.join(m, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = near.unionByName(m.select("u", F.col("m").alias("v"))).distinct()
        edges = stage(small, "edges")
        now = _print(edges)
        if now == seen:
            break
        seen = now
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return labels.unionByName(roots)
