"""Insert-if-absent, merge, change feed, control table, versions on disk."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.changes import (
    empty_control,
    get_watermark,
    next_start,
    post_images,
    set_watermark,
    table_changes,
)
from tidemark.operators.tagged import state_of
from tidemark.operators.upsert import insert_if_absent, merge_source, merge_upsert, new_keys, restrict_to_keys
from tidemark.session import work_path
from tidemark.sources.snapshots import append, latest_version, read_snapshot, read_versions, replace, snapshot_log
from tidemark.streaming.incremental import follow_files, pull_changes


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k int, v string, alt string")


def test_insert_if_absent(spark):
    old, new = frame(spark, (1, "a", "x")), frame(spark, (1, "b", "y"), (2, "c", "z"), (2, "d", "z"))
    assert rows(insert_if_absent(old, new, ["k"])) == [(1, "a", "x"), (2, "c", "z"), (2, "d", "z")]
    assert rows(insert_if_absent(old, new, ["k", "v"]).select("v")) == [("a",), ("b",), ("c",), ("d",)]
    assert rows(new_keys(new, old, ["k"]).select("v")) == [("c",), ("d",)]
    assert rows(restrict_to_keys(new, old, ["k"])) == [(1, "b", "y")]


def test_merge_keeps_a_column_that_is_not_updated(spark):
    old, new = frame(spark, (1, "a", "x"), (3, "c", "w")), frame(spark, (1, "b", "NEW"), (2, "c", "z"))
    got = merge_upsert(old, new, ["k"], ["v"])
    assert rows(got) == [(1, "b", "x"), (2, "c", "z"), (3, "c", "w")]
    assert rows(merge_upsert(old, new, ["k"], ["v"], insert=False)) == [(1, "b", "x"), (3, "c", "w")]


def test_merge_can_set_null_and_stamp(spark):
    old, new = frame(spark, (1, "a", "x"), (3, "c", "w")), frame(spark, (1, None, "y"), (2, "c", "z"))
    got = merge_upsert(old, new, ["k"], stamp={"alt": F.lit("now")})
    assert rows(got) == [(1, None, "now"), (2, "c", "now"), (3, "c", "w")]


def test_merge_refuses_two_source_rows(spark):
    old, new = frame(spark, (1, "a", "x")), frame(spark, (2, "b", "y"), (2, "c", "z"))
    with pytest.raises(Exception, match="more than one row"):
        merge_upsert(old, new, ["k"]).collect()


def test_small_source_leaves_the_target_in_place(spark, sf):
    """A broadcast source: the target is neither shuffled nor sorted."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    source = orders.limit(3)
    plan = merge_upsert(orders, source, ["o_orderkey"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_changes_by_type(spark):
    v1 = frame(spark, (1, "a", "x"), (2, "b", "y"), (3, "c", None))
    v2 = frame(spark, (1, "a", "x"), (2, "B", "y"), (4, "d", "w"))
    got = table_changes({1: v1, 2: v2}, 2, ["k"]).select("k", "v", "_change_type", "_commit_version")
    assert rows(got) == [
        (2, "B", "update_postimage", 2),
        (2, "b", "update_preimage", 2),
        (3, "c", "delete", 2),
        (4, "d", "insert", 2),
    ]
    assert rows(post_images(got).select("k")) == [(2,), (4,)]
    assert rows(table_changes({1: v1, 2: v2}, 1, ["k"], end=1).select("k", "_change_type")) == [
        (1, "insert"), (2, "insert"), (3, "insert"),
    ]


def test_key_that_leaves_and_returns(spark):
    a, none = frame(spark, (1, "a", "x")), frame(spark).limit(0)
    got = table_changes({1: a, 2: none, 3: a}, 1, ["k"]).select("_change_type", "_commit_version")
    assert rows(got) == [("delete", 2), ("insert", 1), ("insert", 3)]


def test_feed_refuses_a_repeated_key(spark):
    v1, v2 = frame(spark, (1, "a", "x")), frame(spark, (1, "a", "x"), (1, "b", "x"))
    with pytest.raises(Exception, match="occurs twice"):
        table_changes({1: v1, 2: v2}, 2, ["k"]).collect()
    with pytest.raises(ValueError):
        table_changes({1: v1}, 5, ["k"])


def test_replaying_the_feed_gives_the_newest_version(spark):
    rng, versions, state = random.Random(5), {}, {}
    for v in range(1, 4):
        for k in range(12):
            dice = rng.random()
            if dice < 0.3:
                state.pop(k, None)
            elif dice < 0.7:
                state[k] = rng.choice("abc")
        versions[v] = frame(spark, *[(k, x, None) for k, x in state.items()])
    feed = table_changes(versions, 2, ["k"]).collect()
    replayed = {r.k: r.v for r in versions[1].collect()}
    for v in (2, 3):
        for r in (r for r in feed if r._commit_version == v):
            if r._change_type == "delete":
                del replayed[r.k]
            elif r._change_type != "update_preimage":
                replayed[r.k] = r.v
    assert replayed == state


def test_watermarks(spark):
    control = empty_control(spark)
    assert get_watermark(control, "t") is None and next_start(control, "t") == 1
    control = set_watermark(control, "t", 12, "2024-01-01 00:00:00")
    assert rows(control) == [("t", 12, datetime(2024, 1, 1))]
    control = set_watermark(control, "t", 13)
    assert next_start(control, "t") == 14 and next_start(control, "other") == 1


def test_versions_on_disk(spark):
    path = work_path(spark, "table")
    assert latest_version(spark, path) is None
    with pytest.raises(ValueError):
        read_snapshot(spark, path)
    a, b = frame(spark, (1, "a", "x")), frame(spark, (2, "b", "y"))
    assert replace(a, path) == 1
    assert append(b, path) == 2
    assert replace(frame(spark).limit(0).withColumn("more", F.lit(1)), path, partition_by=["k"]) == 3
    assert rows(read_snapshot(spark, path, 1).select("k")) == [(1,)]
    assert rows(read_snapshot(spark, path, 2).select("k")) == [(1,), (2,)]
    assert read_snapshot(spark, path).columns == ["k", "v", "alt", "more"] and read_snapshot(spark, path).isEmpty()
    log = snapshot_log(spark, path).orderBy("version").collect()
    assert [(r.version, r.rows, r.note, len(r.folders)) for r in log] == [
        (1, 1, "replace", 1), (2, 2, "append", 2), (3, 0, "replace", 1),
    ]
    assert sorted(read_versions(spark, path, 2, 2)) == [1, 2]


def test_pull_changes_until_nothing_is_new(spark):
    path, control = work_path(spark, "table"), empty_control(spark)
    replace(frame(spark, (1, "a", "x")), path)
    feed, control = pull_changes(spark, control, "t", path, ["k"])
    assert rows(feed.select("k", "_change_type")) == [(1, "insert")]
    replace(frame(spark, (1, "b", "x"), (2, "c", "y")), path)
    feed, control = pull_changes(spark, control, "t", path, ["k"])
    assert rows(post_images(feed).select("k", "v")) == [(1, "b"), (2, "c")]
    assert pull_changes(spark, control, "t", path, ["k"])[0] is None


def test_follow_files(spark):
    """Files that arrive between the calls are merged; nothing is read twice."""
    inbox, path, seen = (work_path(spark, n) for n in ("inbox", "table", "seen"))
    schema = "k int, v string, alt string"

    def load(target, batch):
        return merge_upsert(target, batch, ["k"])

    def run():
        arriving = spark.readStream.schema(schema).parquet(inbox)
        return follow_files(arriving, path, frame(spark).limit(0), load, seen)

    frame(spark, (1, "a", "x"), (2, "b", "y")).coalesce(1).write.parquet(inbox)
    assert run() == 1
    frame(spark, (2, "B", "y"), (3, "c", "z")).coalesce(1).write.mode("append").parquet(inbox)
    assert run() == 2
    assert run() == 2
    assert rows(read_snapshot(spark, path)) == [(1, "a", "x"), (2, "B", "y"), (3, "c", "z")]


def test_merge_checks_its_source_with_an_empty_target(spark):
    source = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    with pytest.raises(Exception, match="more than one row for a key"):
        merge_upsert(source.limit(0), source, ["k"]).collect()


def test_insert_one_per_key(spark):
    source = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert rows(insert_if_absent(source.limit(0), source, ["k"], one_per_key=True)) == [(1, "b"), (2, "c")]


def test_a_failed_commit_does_not_block_the_table(spark, monkeypatch):
    from tidemark.sources import snapshots

    path, df = work_path(spark, "crash"), spark.range(3)
    replace(df, path)
    with monkeypatch.context() as m:
        m.setattr(snapshots, "_commit", lambda *a: 1 / 0)  # data written, log file lost
        with pytest.raises(ZeroDivisionError):
            replace(df, path)
    assert latest_version(spark, path) == 1
    assert append(df, path) == 2 and read_snapshot(spark, path).count() == 6


def test_the_second_of_two_writers_is_refused(spark, monkeypatch):
    from tidemark.sources import snapshots

    path, df = work_path(spark, "race"), spark.range(3)
    replace(df, path)
    stale = snapshots._entry(spark, path)
    append(df, path)
    with monkeypatch.context() as m:
        m.setattr(snapshots, "_entry", lambda *a: stale)  # read before the other writer's commit
        with pytest.raises(ValueError, match="another writer"):
            append(df, path)
    assert read_snapshot(spark, path).count() == 6
    with pytest.raises(ValueError):
        replace(df, path, cluster_by=["id"], files=2, partition_by=["id"])


def test_a_whole_row_merge_exchanges_only_the_keys_of_its_source(spark):
    """Rows that a match takes whole from the source stay where they are; keys that
    the target holds twice, or not at all, come as from a join."""
    old = frame(spark, (1, "a", "x"), (2, "b", "y"), (2, "c", None), (None, "d", "z"), (4, "e", "w"))
    new = frame(spark, (2, "B", None), (3, "C", "n"), (None, "D", "m"), (4, None, "o"))
    for stamp in ({}, {"alt": F.lit("now")}):
        want = rows(state_of(merge_upsert(old, new, ["k"], stamp=stamp, feed=True)))
        assert rows(merge_upsert(old, new, ["k"], stamp=stamp)) == want and len(want) == 7
    # A stamp that reads a column reads the target's.
    stamp = {"alt": F.concat("v", F.lit("!"))}
    want = rows(state_of(merge_upsert(old, new, ["k"], stamp=stamp, feed=True)))
    assert rows(merge_upsert(old, new, ["k"], stamp=stamp)) == want and (2, "B", "b!") in want

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        once = old.filter("v <> 'c'")
        plan = merge_upsert(once, merge_source(new, ["k"]), ["k"], checked=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange") == 2 and "_src" not in plan
