"""Slots: what a load reads, writes and tells about itself."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, shuffle_files
from tests.test_lakehouse import FIRST, SECOND, write_raw
from tidemark.operators.changes import empty_control, table_changes
from tidemark.operators.layout import Borders, find_borders
from tidemark.operators.scd2 import scd2_apply
from tidemark.operators.tagged import feed_of, state_of
from tidemark.operators.upsert import merge_upsert
from tidemark.plans.lakehouse import FACT, Lakehouse
from tidemark.session import scratch, shared_dir, stage, work_path
from tidemark.sources import snapshots
from tidemark.sources.bucketed import read_bucketed, write_bucketed
from tidemark.sources.snapshots import (
    Slots,
    append,
    append_slots,
    changed_slots,
    compact_slots,
    last_version,
    read_feed,
    read_snapshot,
    read_versions,
    replace,
    replace_slots,
    slot_of,
    snapshot_log,
    versions,
)
from tidemark.streaming.incremental import pull_changes

HISTORY = "k long, at timestamp, v string, _ingestion_timestamp timestamp, is_current boolean, end_date timestamp"
BY_KEY = Slots.by_hash(["k"], 8)


def batch(spark, *data):
    return spark.createDataFrame(list(data), "k long, at string, v string").withColumn("at", F.col("at").cast("timestamp"))


def load(spark, path, new, as_of):
    """One load of the history at ``path``; returns the touched slots and the plain next state."""
    known = snapshots.latest_version(spark, path) is not None
    empty = spark.createDataFrame([], HISTORY)
    whole = read_snapshot(spark, path) if known else empty
    plain = rows(scd2_apply(whole, new, ["k"], ["v"], "at", as_of=as_of))
    touched = BY_KEY.touched(new, empty.schema)
    target = read_snapshot(spark, path, slots=touched) if known else empty
    state = scd2_apply(target, new, ["k"], ["v"], "at", as_of=as_of, feed=True)
    replace_slots(state, path, BY_KEY, touched, sort_by=["k", "at"])
    assert rows(read_snapshot(spark, path)) == plain
    return touched


def files_below(df):
    return [f.split("/data/")[1] for f in df.inputFiles()]


def test_a_load_writes_the_slots_it_touches_and_its_feed(spark):
    path = work_path(spark, "table")
    load(spark, path, batch(spark, *[(i, "2024-01-01", f"v{i}") for i in range(100)]), "2024-01-02")
    first = versions(spark, path, 1)[1]
    assert {slot_of(f) for f in first.folders} == set(range(8)) and first.rows == 100

    # One changed key: one slot is read and written, the others keep their folders.
    touched = load(spark, path, batch(spark, (7, "2024-02-01", "new")), "2024-02-02")
    second = last_version(spark, path)
    assert len(touched) == len(second.added) == len(second.removed) == 1 and second.rows == 101
    assert set(second.folders) - set(second.added) == set(first.folders) - set(second.removed)
    assert changed_slots(spark, path, 2) == touched
    # The change feed is what comparing both versions says, and opens no table folder.
    feed, control = pull_changes(spark, empty_control(spark), "t", path, ["k", "at"])
    assert all("_out=feed" in f for f in files_below(feed)) and len(files_below(feed)) >= 2
    both = read_versions(spark, path, 1)
    want = table_changes(both, 1, ["k", "at"]).select(feed.columns)
    assert rows(feed) == rows(want) and feed.count() == 103
    assert pull_changes(spark, control, "t", path, ["k", "at"])[0] is None
    # The same batch again changes nothing and leaves nothing.
    load(spark, path, batch(spark, (7, "2024-02-01", "new")), "2024-03-02")
    assert last_version(spark, path).version == 2
    assert len(os.listdir(f"{path}/data")) == 2

    # A key with two changes, a new key and a NULL value.
    load(spark, path, batch(spark, (7, "2024-03-01", "a"), (7, "2024-03-05", None), (500, "2024-03-01", None)), "2024-03-06")
    kinds = [r._change_type for r in read_feed(spark, path, last_version(spark, path)).collect()]
    assert sorted(kinds) == ["insert"] * 3 + ["update_postimage", "update_preimage"]


def test_rows_outside_of_the_touched_slots_fail(spark):
    path, all_rows = work_path(spark, "table"), spark.range(50).withColumnRenamed("id", "k")
    replace_slots(all_rows, path, BY_KEY)
    with pytest.raises(Exception, match="outside of the touched slots"):
        replace_slots(all_rows, path, BY_KEY, [1, 2])
    with pytest.raises(ValueError, match="is dealt by"):
        replace_slots(all_rows, path, Slots.by_hash(["k"], 9), [1])
    # A slot that loses all its rows has no folder; one replaced by none is gone.
    one = read_snapshot(spark, path, slots=[1])
    assert 0 < one.count() < 50
    replace_slots(one.limit(0), path, BY_KEY, [1])
    assert last_version(spark, path).rows == read_snapshot(spark, path).count() == 50 - one.count()
    # The hash is that of the declared type, whatever the batch holds.
    assert BY_KEY.touched(spark.range(50).select(F.col("id").cast("int").alias("k")), all_rows.schema) == list(range(8))


def test_tagged_merge(spark):
    schema = "k int, v string, at string"
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "x")], schema)
    new = spark.createDataFrame([(1, "A", "x"), (2, "b", "x"), (4, None, None)], schema)
    both = merge_upsert(old, new, ["k"], feed=True)
    assert rows(state_of(both)) == rows(merge_upsert(old, new, ["k"]))
    assert rows(feed_of(both)) == [
        (1, "A", "x", "update_postimage"), (1, "a", "x", "update_preimage"), (4, None, None, "insert"),
    ]
    assert rows(feed_of(merge_upsert(old.limit(0), new, ["k"], feed=True)).select("_change_type")) == [("insert",)] * 3


def test_months_and_cells(spark):
    path = work_path(spark, "fact")
    day = (F.lit(20240100) + F.col("id") % 3 * 100 + F.col("id") % 28 + 1).cast("int")
    df = spark.range(30000).select(
        F.when(F.col("id") % 1000 != 0, day).alias("day"), (F.col("id") * 7919 % 5000).alias("customer"), (F.col("id") % 40).alias("product")
    )
    slots = Slots.by_month("day")
    replace_slots(df, path, slots, sort_by=["customer", "product"], cells=8)
    assert sorted(slot_of(f) for f in last_version(spark, path).folders) == [0, 202401, 202402, 202403]
    assert rows(read_snapshot(spark, path)) == rows(df)
    month = read_snapshot(spark, path, slots=[202402])
    assert month.count() == df.filter("day between 20240200 and 20240299").count()
    assert all("_slot=202402" in f for f in files_below(month))
    # Later rows are laid out by the borders of the first.
    first = last_version(spark, path).borders
    replace_slots(month.filter("customer < 100"), path, slots, [202402], sort_by=["customer", "product"], cells=8)
    again = last_version(spark, path)
    assert again.borders == first and len(again.removed) == 1
    assert Borders.load(first).cols == ("customer", "product")


def test_a_stored_load_leaves_no_shuffle_files(spark):
    before, path = shuffle_files(spark), work_path(spark, "table")
    data = [(i, f"2024-{i % 12 + 1:02d}-01", "v") for i in range(100)]
    replace_slots(batch(spark, *data).repartition(3, "v"), path, BY_KEY, sort_by=["k", "at"])
    assert shuffle_files(spark) <= before and read_snapshot(spark, path).count() == 100


def test_appended_rows_are_laid_out_and_compacted_by_slot(spark):
    path, slots, layout = work_path(spark, "table"), Slots.by_month("day"), {"sort_by": ["a", "b"], "cells": 4}
    rows_of = lambda lo, hi, month: spark.range(lo, hi).select(
        F.lit(20240001 + 100 * month).alias("day"), (F.col("id") * 37 % 1000).alias("a"), F.col("id").alias("b")
    )
    append_slots(rows_of(0, 4000, 1), path, slots, **layout)
    first = last_version(spark, path)
    for i in range(3):
        append_slots(rows_of(5000 + i * 100, 5100 + i * 100, 1), path, slots, **layout)
    append_slots(rows_of(9000, 9100, 2), path, slots, **layout)
    # An append adds one folder and takes none away; nothing new leaves no version.
    last = last_version(spark, path)
    assert last.version == 5 and last.folders[0] == first.folders[0] and not last.removed and len(last.added) == 1
    assert append_slots(rows_of(0, 0, 1), path, slots, **layout) == 5
    before, control = rows(read_snapshot(spark, path)), pull_changes(spark, empty_control(spark), "t", path, ["b"])[1]
    kept = [f for f in last.folders if slot_of(f) == 202402]
    assert compact_slots(spark, path, slots, most=3, **layout) == 6
    assert compact_slots(spark, path, slots, most=3, **layout) is None
    now = last_version(spark, path)
    assert len(now.folders) == 2 and kept[0] in now.folders and len(now.removed) == 4 and now.borders == first.borders
    assert rows(read_snapshot(spark, path)) == before
    # Compaction is no change.
    assert changed_slots(spark, path, 6) == [] and pull_changes(spark, control, "t", path, ["b"])[0].isEmpty()


def test_borders_are_found_in_one_pass_and_kept_as_text(spark):
    df = spark.range(1000).select("id", (F.col("id") % 50).cast("string").alias("name"), F.lit(None).cast("double").alias("none"))
    found = find_borders(df, ["id", "name", "none"], 8)
    assert Borders.load(json.dumps(json.loads(found.dump()))) == found
    keys = [r[0] for r in df.select(Borders.load(found.dump()).key(df.schema)).collect()]
    assert keys == [r[0] for r in df.select(found.key(df.schema)).collect()] and len(set(keys)) > 8
    cells = {r[0] for r in df.select(found.cell(found.key(df.schema), 4)).collect()}
    assert cells <= set(range(4)) and len(cells) > 1


def test_the_log_stays_small(spark, monkeypatch):
    monkeypatch.setattr(snapshots, "FULL_EVERY", 4)
    monkeypatch.setattr(snapshots, "FEW", 2)
    path = work_path(spark, "table")
    for i in range(1, 10):
        assert append(spark.range(i, i + 1), path) == i
    log = {r.version: r.folders for r in snapshot_log(spark, path).collect()}
    assert [v for v, f in log.items() if f is not None and v > 2] and {v for v in log if log[v] is None} == {3, 4, 6, 7, 8}
    for i in (1, 3, 4, 5, 8, 9):
        assert rows(read_snapshot(spark, path, i)) == [(j,) for j in range(1, i + 1)]
    assert [len(v.folders) for v in versions(spark, path, 6, 8).values()] == [6, 7, 8]


def test_scratch_deletes_its_copies(spark):
    with pytest.raises(RuntimeError), scratch():
        copy = stage(spark.range(3), "kept-a-while")
        assert os.path.isdir(copy._staged_at)
        raise RuntimeError
    assert not os.path.isdir(copy._staged_at)
    assert os.path.isdir(stage(spark.range(3), "outside")._staged_at)


class Broken(Lakehouse):
    """Breaks off at a store."""

    at = ""

    def _store(self, table, df, **layout):
        if table == self.at:
            raise RuntimeError(table)
        super()._store(table, df, **layout)


@pytest.fixture(scope="module")
def lake_root(spark):
    root = work_path(spark, "lake")
    Lakehouse(spark, root, files=1, as_of="2024-03-02 00:00:00", slots=2).load_all(write_raw(spark, FIRST), FIRST)
    return root


def test_a_run_that_breaks_off_between_its_stores(spark, lake_root):
    """Data without their control row are not taken in twice, and newer changes wait for the next run."""
    copies = lambda: {n for n in os.listdir(f"{shared_dir(spark)}/work") if not n.startswith("raw-")}
    before = copies()
    lake = Broken(spark, lake_root, files=1, as_of="2024-04-02 00:00:00", slots=2)
    lake.load_silver(write_raw(spark, SECOND), SECOND)
    for table in ("gold/dim_customer", "gold/pipeline_control"):
        lake.at = table
        with pytest.raises(RuntimeError, match=table):
            lake.load_customers()
    # A product held twice would double its lines: nothing is stored.
    product, before_load = lake.gold("dim_product"), last_version(spark, lake.path(FACT)).version
    replace(product.union(product), lake.path("gold/dim_product"))
    with pytest.raises(ValueError, match="more than once.*product_id"):
        lake.load_fact()
    assert last_version(spark, lake.path(FACT)).version == before_load
    replace(product, lake.path("gold/dim_product"))
    lake.at = "gold/pipeline_control"
    with pytest.raises(RuntimeError):
        lake.load_fact()
    assert lake.looked_up["territory_id"] == {"unmatched": 0, "dropped": 0, "multiplied": 0}
    fact_version = last_version(spark, lake.path(FACT)).version
    # A third change arrives before the run is repeated.
    third = {"sales_customer": [{**SECOND["sales_customer"][0], "AccountNumber": "AW9", "ModifiedDate": "2024-05-01 00:00:00"}]}
    lake.load_silver(write_raw(spark, third), third)
    lake.at = ""
    assert lake.load_customers() and lake.load_fact()
    assert last_version(spark, lake.path(FACT)).version == fact_version
    history = lambda: rows(lake.gold("dim_customer_history").select(F.col("valid_from").cast("string"), F.col("valid_to").cast("string")))
    assert history() == [("2024-03-01 00:00:00", "2024-04-01 00:00:00")]
    assert lake.load_customers() and not lake.load_customers()
    assert history() == [("2024-03-01 00:00:00", "2024-04-01 00:00:00"), ("2024-04-01 00:00:00", "2024-05-01 00:00:00")]
    # No copy of any load is left, also not of those that broke off.
    assert copies() == before


def test_the_monthly_aggregate_of_touched_months(spark, lake_root):
    lake = Lakehouse(spark, lake_root, files=1, as_of="2024-06-02 00:00:00", slots=2)
    lake.load_monthly()
    assert lake.load_monthly() == []
    header = {**FIRST["sales_salesorderheader"][0], "SalesOrderID": 2, "SalesOrderNumber": "SO2", "OrderDate": "2024-05-05 00:00:00", "ModifiedDate": "2024-06-01 00:00:00"}
    detail = {**FIRST["sales_salesorderdetail"][0], "SalesOrderID": 2}
    more = {"sales_salesorderheader": [header], "sales_salesorderdetail": [detail]}
    lake.load_silver(write_raw(spark, more), more)
    assert lake.load_fact() and lake.load_monthly() == [202405]
    # An order moves to another month: both months are told anew.
    moved = {"sales_salesorderheader": [{**header, "Status": 6, "OrderDate": "2024-04-07 00:00:00", "ModifiedDate": "2024-06-02 00:00:00"}]}
    lake.load_silver(write_raw(spark, moved), moved)
    assert lake.load_fact() and lake.load_monthly() == [202404, 202405]
    assert rows(lake._read("gold/agg_monthly_sales", None).select("OrderYear", "OrderMonth", "TotalOrders")) == [(2024, 3, 1), (2024, 4, 1)]
    # A territory that changes its name touches the months of its sales.
    there = lake.gold("dim_sales_territory").withColumn("sales_group_name", F.lit("Elsewhere"))
    lake._store("gold/dim_sales_territory", there)
    assert lake.load_monthly() == [202403, 202404]
    assert {r[0] for r in lake._read("gold/agg_monthly_sales", None).select("TerritoryGroup").collect()} == {"Elsewhere"}


def plan_lines(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return [(len(line) - len(line.lstrip(" :+-")), line) for line in text.splitlines() if line.strip()]


def test_a_bucketed_target_is_not_shuffled(spark):
    path, after = work_path(spark, "buckets"), work_path(spark, "buckets")
    schema = spark.createDataFrame([], HISTORY).schema
    first = scd2_apply(spark.createDataFrame([], HISTORY), batch(spark, *[(i % 40, f"2024-01-{i % 20 + 1:02}", f"v{i}") for i in range(200)]), ["k"], ["v"], "at", as_of="2024-02-01")
    write_bucketed(first, path, ["k"], 4)
    target = read_bucketed(spark, path, schema, ["k"], 4)
    assert rows(target) == rows(first)
    new = batch(spark, *[(k, "2024-03-01", "new") for k in range(30, 60)])
    keep = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for c in keep:
            spark.conf.set(c, "-1")
        state = scd2_apply(target, new, ["k"], ["v"], "at", as_of="2024-03-02", buckets=4)
        lines = plan_lines(state)
        scans = exchanges = 0
        for i, (depth, line) in enumerate(lines):
            if "Exchange" in line:
                exchanges += 1
                below = [x for d, x in lines[i + 1 : next((j for j in range(i + 1, len(lines)) if lines[j][0] <= depth), len(lines))]]
                assert not any("Bucketed: true" in x for x in below), line
            scans += "Bucketed: true" in line
        assert scans >= 2 and exchanges >= 1
        write_bucketed(state, after, ["k"], 4, dealt=True)
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)
    again = read_bucketed(spark, after, schema, ["k"], 4)
    assert rows(again) == rows(scd2_apply(first, new, ["k"], ["v"], "at", as_of="2024-03-02"))
    assert len(again.inputFiles()) == 4


def test_two_fact_loads_leave_nothing_but_the_lake(spark, sf):
    """Copies and shuffle files of a load are gone before the next one."""
    from workload.slots import _loaded_fact

    work = f"{shared_dir(spark)}/work"
    before, found = set(os.listdir(work)) if os.path.exists(work) else set(), []
    _loaded_fact(spark, sf, between=lambda lake: found.append({d.split("-")[0] for d in set(os.listdir(work)) - before}))
    assert found == [{"lake", "lines"}] * 2
    assert {d.split("-")[0] for d in set(os.listdir(work)) - before} == {"lake"}
