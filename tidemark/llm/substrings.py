"""Queries on repeated substrings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.chunks import repeated_chunks
from tidemark.llm.registry import query, read
from tidemark.llm.suffixes import repeated_bytes


@query("op10_chunk_dedup")
def chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_chunks(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_chunks", "n_repeated", "n_removed",
        F.size("spans").cast("long").alias("n_spans"), (F.col("n_removed") > 0).alias("repeated"),
    )


@query("op6_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(read(spark, sf_dir, "documents")).drop("spans")
