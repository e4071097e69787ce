"""Queries that score or mark each text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.crf import extract_main_text
from tidemark.llm.language_model import score_language_model
from tidemark.llm.licences import licence_scan
from tidemark.llm.nbsvm import fit, labelled_texts, score_texts
from tidemark.llm.registry import query, read
from tidemark.session import discard


def quality_model(docs: DataFrame, labels: DataFrame):
    """Model of the labelled rows that are not held out."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    labelled = labelled_texts(docs.filter(~held), labels)
    model = fit(labelled)
    discard(labelled)
    return model, held


@query("op1_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model, held = quality_model(docs, read(spark, sf_dir, "labels"))
    told = score_texts(docs.select("doc_id", held.alias("held_out"), "text"), model)
    return told.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op4_licence_scan")
def licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(read(spark, sf_dir, "documents"))


@query("op2_language_model")
def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = "crc32(cast(cast(doc_id as string) as binary)) % 10 <> 0"
    return score_language_model(read(spark, sf_dir, "documents"), train)


@query("op5_main_text")
def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read(spark, sf_dir, "pages"))
