"""Exact duplicates, with the frequent digests handled before the shuffle.

A Misra-Gries summary of ``heavy`` counters per task, merged, holds every digest
with more than rows / (heavy + 1) copies. Those few digests are counted exactly,
their winners broadcast (at most ``heavy`` rows, whatever the input), and their
rows settled where they are. All other digests go through an ordinary shuffle:
their winners are combined before it and joined back.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.session import stage

HEAVY = 1000
BLANKS = "\x20\t\n\x0b\x0c\r"


def cut(counts: Counter, size: int) -> Counter:
    """Misra-Gries reduction: take the (size + 1)-th count off all of them."""
    if len(counts) <= size:
        return counts
    off = sorted(counts.values(), reverse=True)[size]
    return Counter({k: n - off for k, n in counts.items() if n > off})


def frequent(digests: DataFrame, size: int) -> DataFrame:
    """At most ``size`` digests, among them all above rows / (size + 1)."""

    def summarise(batches):
        counts: Counter = Counter()
        for b in batches:
            counts.update(b.column(0).to_pylist())
            counts = cut(counts, size)
        yield pa.RecordBatch.from_pydict({
            "_digest": pa.array(list(counts.keys()), pa.string()),
            "_n": pa.array(list(counts.values()), pa.int64()),
        })

    parts = digests.select("_digest").mapInArrow(summarise, "_digest string, _n long")
    summed = parts.groupBy("_digest").agg(F.sum("_n").alias("_n"))
    top = summed.orderBy(F.desc("_n"), "_digest").limit(size + 1).collect()
    off = top[size]["_n"] if len(top) > size else 0
    kept = [(r["_digest"],) for r in top[:size] if r["_n"] > off]
    return digests.sparkSession.createDataFrame(kept, "_digest string")


def exact_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
    heavy: int = HEAVY,
) -> DataFrame:
    """One row per row of ``docs``: key, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``, and the ``carry`` columns.

    Texts are equal without their blanks; NULL is the empty text. The longest
    original text stays, then the smallest key (NULL last); of rows alike in
    both, exactly one is kept. An empty table gives an empty result; other
    columns are ignored, so their names cannot clash.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    carried = [c for c in carry if c != key]
    rows = stage(
        docs.select(
            F.col(f"`{key}`").alias("_key"),
            F.sha2(F.regexp_replace(body, f"[{BLANKS}]+", ""), 256).alias("_digest"),
            F.char_length(body).cast("long").alias("_chars"),
            F.xxhash64(body).alias("_tie"),
            F.monotonically_increasing_id().alias("_row"),
            *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carried)],
        ),
        "digests",
    )
    rank = F.struct(
        (-F.col("_chars")).alias("c"), F.col("_key").isNull().alias("z"),
        F.col("_key").alias("k"), F.col("_tie").alias("t"), F.col("_row").alias("r"),
    )
    top = frequent(rows, heavy)
    winners = F.broadcast(
        rows.join(F.broadcast(top), "_digest")
        .groupBy("_digest")
        .agg(F.min(rank).alias("_win"), F.count(F.lit(1)).alias("_size"))
    )
    split = rows.join(winners, "_digest", "left")
    hot = split.filter(F.col("_win").isNotNull())
    # Winners and counts are combined before their shuffle; the rows that join
    # them are split by adaptive execution where a digest has many.
    cold = split.filter(F.col("_win").isNull()).drop("_win", "_size")
    won = cold.groupBy("_digest").agg(F.min(rank).alias("_win"), F.count(F.lit(1)).alias("_size"))
    rest = cold.join(won, "_digest")
    return hot.unionByName(rest).select(
        F.col("_key").alias(key),
        F.col("_win.k").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_row") == F.col("_win.r")).alias("kept"),
        F.col("_digest").alias("text_sha256"),
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carried)],
    )
