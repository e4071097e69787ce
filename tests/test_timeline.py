"""Rank, neighbours, compression and latest value, also for hot keys."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import skew
from tidemark.operators.skew import hot_keys
from tidemark.operators.timeline import (
    compress_versions,
    latest_per_key,
    prev_values,
    rank_versions,
    with_latest,
)

SCHEMA = "k int, at int, id int, v string, w int"


def history(seed: int, n: int = 400):
    """Two thirds of the rows belong to key 1; dates repeat within a key."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = 1 if rng.random() < 0.66 else rng.randrange(2, 6)
        out.append((k, rng.randrange(60), i, rng.choice(["a", "b", None]), rng.randrange(2)))
    return out


def test_rank_and_older_date(spark):
    df = spark.createDataFrame([(1, 10, 1, "a", 0), (1, 20, 2, "b", 0), (2, 5, 3, "c", 0)], SCHEMA)
    got = rank_versions(df, ["k"], "at").select("k", "at", "rn", "next_version_date")
    assert rows(got) == [(1, 10, 2, None), (1, 20, 1, 10), (2, 5, 1, None)]


def test_composite_key(spark):
    df = spark.createDataFrame([(1, 1, 1, "a", 2), (1, 2, 2, "a", 3), (1, 3, 3, "a", 2)], SCHEMA)
    got = rank_versions(df, ["k", "w"], "at").select("w", "at", "rn")
    assert rows(got) == [(2, 1, 2), (2, 3, 1), (3, 2, 1)]


def test_compress_keeps_first_and_changes(spark):
    data = [(1, 1, 1, "a", 0), (1, 2, 2, "a", 0), (1, 3, 3, "b", 0), (1, 4, 4, "a", 0), (2, 1, 5, None, 0)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(compress_versions(df, ["k"], "at", ["v"]).select("id")) == [(1,), (3,), (4,), (5,)]


def test_null_change_counts_only_when_null_safe(spark):
    df = spark.createDataFrame([(1, 1, 1, "a", 0), (1, 2, 2, None, 0), (1, 3, 3, "b", 0)], SCHEMA)
    assert len(rows(compress_versions(df, ["k"], "at", ["v"]))) == 3
    assert len(rows(compress_versions(df, ["k"], "at", ["v"], null_safe=False))) == 1


def test_previous_values_are_read_from_one_row(spark):
    df = spark.createDataFrame([(1, 1, 1, "a", 7), (1, 2, 2, None, 8), (1, 3, 3, "b", 9)], SCHEMA)
    got = prev_values(df, ["k"], "at", ["v", "w"]).select("id", "prev_v", "prev_w")
    assert rows(got) == [(1, None, None), (2, "a", 7), (3, None, 8)]


@pytest.mark.parametrize("seed, hot_rows", [(1, 20), (2, 60)])
def test_hot_keys_give_the_same_rows(spark, seed, hot_rows):
    df = spark.createDataFrame(history(seed), SCHEMA).repartition(4)
    ops = [
        lambda d, h: rank_versions(d, ["k"], "at", ["id"], hot_rows=h),
        lambda d, h: prev_values(d, ["k"], "at", ["v", "w"], ["id"], hot_rows=h),
        lambda d, h: compress_versions(d, ["k"], "at", ["v"], ["id"], hot_rows=h),
        lambda d, h: with_latest(d, ["k"], "at", ["v", "w"], ["id"], hot_rows=h),
    ]
    for op in ops:
        assert rows(op(df, hot_rows)) == rows(op(df, 10**9))


def test_copies_of_one_version_are_all_ranked(spark):
    """Exact copies hold most rows; each keeps its place in the rank."""
    df = spark.createDataFrame([(1, 5, 0, "a", 0)] * 300 + [(1, 9, 1, "b", 0)], SCHEMA).repartition(5)
    got = rank_versions(df, ["k"], "at", ["id"], hot_rows=10).collect()
    assert sorted(r.rn for r in got) == list(range(1, 302))
    assert sum(r.next_version_date is None for r in got) == 1


def test_null_may_be_the_hot_key(spark):
    data = [(None, i, i, "a", 0) for i in range(50)] + [(2, 1, 99, "b", 0)]
    df = spark.createDataFrame(data, SCHEMA)
    got = rank_versions(df, ["k"], "at", ["id"], hot_rows=10)
    assert sorted(r.rn for r in got.collect() if r.k is None) == list(range(1, 51))
    newest = with_latest(df, ["k"], "at", ["id"], hot_rows=10)
    assert {(r.k, r.id) for r in newest.collect()} == {(None, 49), (2, 99)} and newest.count() == 51


def test_hot_probe(spark, monkeypatch):
    df = spark.createDataFrame(history(3), SCHEMA)
    assert hot_keys(df, ["k"]) is None
    monkeypatch.setattr(skew, "HOT_ROWS", 100)  # the default is looked at for small tables too
    assert rows(hot_keys(df, ["k"])) == [(1,)]
    assert hot_keys(df, ["k"], 10**6) is None
    assert rows(hot_keys(df, ["k"], 100)) == [(1,)]


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.createDataFrame(history(4), SCHEMA)
    got = latest_per_key(df, ["k"], ["at", "id"])
    best = {}
    for r in df.collect():
        best[r.k] = max(best.get(r.k, (-1, -1)), (r.at, r.id))
    assert rows(got.select("k", "at", "id")) == sorted((k, *v) for k, v in best.items())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")


def test_one_shuffle_for_rank(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    plan = rank_versions(events, ["user_id"], "ts", ["event_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
