"""The training-text pipeline: five operators, each on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.decontaminate import contaminated_words
from tidemark.llm.exact import exact_duplicates
from tidemark.llm.marking import quality_model
from tidemark.llm.mixing import mix_sources
from tidemark.llm.near import near_duplicates
from tidemark.llm.nbsvm import score_texts
from tidemark.llm.registry import read
from tidemark.session import stage

_USED = ("doc_id", "text", "source")


def _packed(docs: DataFrame) -> DataFrame:
    """The columns in use, and all others in one struct, so that no name clashes."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in _USED]
    return docs.select(*_USED, (F.struct(*rest) if rest else F.lit(None)).alias("_rest"))


def _columns(docs: DataFrame) -> list:
    return [F.col(c) if c in _USED else F.col("_rest")[c].alias(c) for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    rows = _packed(docs)
    model, _ = quality_model(rows, read(spark, sf_dir, "labels"))
    return score_texts(rows, model).filter("score >= 0.5").select(*_columns(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    found = exact_duplicates(_packed(docs), carry=("text", "source", "_rest"))
    return found.filter("kept").select(*_columns(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    found = near_duplicates(_packed(docs), carry=("text", "source", "_rest"))
    return found.filter("kept").select(*_columns(docs))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = contaminated_words(_packed(docs), read(spark, sf_dir, "benchmark"), carry=("text", "source", "_rest"))
    return found.filter("not contaminated").select(*_columns(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its place in the mix, in columns named ``mix_...``."""
    placed = mix_sources(_packed(docs), carry=("text", "_rest"))
    mark = "mix_"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    own = [F.col(c).alias(mark + c) for c in ("block_no", "block_pos", "release", "deadline", "slot", "on_target")]
    return placed.select(*_columns(docs), *own)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("benchmark decontamination", benchmark),
    ("source mixing", mixing),
]

# The classifier has no SQL form; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; the others' are written to the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
