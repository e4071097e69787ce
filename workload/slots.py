"""Loads that write only the slots they touch, and what they leave beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.changes import empty_control, set_watermark
from tidemark.operators.scd2 import scd2_apply
from tidemark.operators.tagged import feed_of
from tidemark.operators.upsert import merge_source, merge_upsert
from tidemark.plans.fact import FACT_KEYS, fact_load, fact_sales
from tidemark.plans.gold import empty_gold
from tidemark.plans.lakehouse import FACT, FACT_SLOTS, Lakehouse
from tidemark.session import discard, scratch, stage, work_path
from tidemark.sources.bucketed import read_bucketed, write_bucketed
from tidemark.sources.snapshots import Slots, changed_slots, last_version, read_snapshot, replace, replace_slots
from tidemark.streaming.incremental import pull_changes
from workload.base import (
    FIRST_LOAD,
    SECOND_LOAD,
    UNIQUE_LINES_SQL,
    detail_of,
    fact_sql,
    gold_dims,
    header_of,
    query,
    read,
    unique_lines,
)
from workload.history import _TARGET_SQL, WATCHED, _apply_sql, _batch, _target

BY_USER = Slots.by_hash(["user_id"], 16)


def _stored_history(spark: SparkSession, sf_dir: str) -> str:
    """Two stored loads of the events' history, dealt to slots by user."""
    path, target = work_path(spark, "history"), _target(spark, sf_dir)
    replace_slots(target, path, BY_USER, sort_by=["user_id", "ts"])
    batch = _batch(spark, sf_dir)
    touched = BY_USER.touched(batch, target.schema)
    state = scd2_apply(
        read_snapshot(spark, path, slots=touched), batch, ["user_id"], WATCHED, "ts",
        ties=["event_id"], as_of=SECOND_LOAD, feed=True,
    )
    replace_slots(state, path, BY_USER, touched, sort_by=["user_id", "ts"])
    return path


@query("scd2_slots_events", _apply_sql("user_id", WATCHED), end_date=True)
def run_scd2_slots(spark, sf_dir):
    return read_snapshot(spark, _stored_history(spark, sf_dir))


@query(
    "history_feed_events",
    f"""
WITH before AS ({_TARGET_SQL}), after AS ({_apply_sql("user_id", WATCHED)}),
closed AS (SELECT a.event_id FROM after a JOIN before b USING (event_id) WHERE b.is_current AND NOT a.is_current)
SELECT *, 'insert' AS _change_type, 2 AS _commit_version FROM after WHERE event_id NOT IN (SELECT event_id FROM before)
UNION ALL SELECT *, 'update_preimage', 2 FROM before WHERE event_id IN (SELECT event_id FROM closed)
UNION ALL SELECT *, 'update_postimage', 2 FROM after WHERE event_id IN (SELECT event_id FROM closed)
""",
    end_date=True,
)
def run_history_feed(spark, sf_dir):
    """The changes that the second load wrote beside its version."""
    control = set_watermark(empty_control(spark), "events", 1, FIRST_LOAD)
    return pull_changes(spark, control, "events", _stored_history(spark, sf_dir), ["event_id"], SECOND_LOAD)[0]


@query("scd2_bucketed_events", _apply_sql("user_id", WATCHED), end_date=True)
def run_scd2_bucketed(spark, sf_dir):
    """A load over a target in buckets by user, written in the same buckets."""
    first, second = work_path(spark, "buckets"), work_path(spark, "buckets")
    stored, n = _target(spark, sf_dir), 8
    write_bucketed(stored, first, ["user_id"], n)
    target = read_bucketed(spark, first, stored.schema, ["user_id"], n)
    state = scd2_apply(
        target, _batch(spark, sf_dir), ["user_id"], WATCHED, "ts", ties=["event_id"], as_of=SECOND_LOAD, buckets=n
    )
    write_bucketed(state, second, ["user_id"], n, dealt=True)
    return read_bucketed(spark, second, stored.schema, ["user_id"], n)


# Between the loads, orders of one month get dearer and those from 1998 on arrive.
_DEARER = "o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01'"
_NEW = "o_orderdate >= TIMESTAMP '1998-06-01'"
_AFTER_SQL = f"SELECT * REPLACE (CASE WHEN {_DEARER} THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice) FROM orders"


def _orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders of the first load, all of them as they are at the second, and those
    that the second load brings."""
    orders = read(spark, sf_dir, "orders")
    dearer, new = (F.expr(c.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")) for c in (_DEARER, _NEW))
    after = orders.withColumn("o_totalprice", F.when(dearer, F.col("o_totalprice") + 100).otherwise(F.col("o_totalprice")))
    return orders.filter(~new), after, after.filter(dearer | new)


def _loaded_fact(spark: SparkSession, sf_dir: str, between=lambda lake: None) -> Lakehouse:
    """A lake whose fact was loaded twice, the second time with the changed orders."""
    root = work_path(spark, "lake")
    first, second = (Lakehouse(spark, root, files=4, as_of=at) for at in (FIRST_LOAD, SECOND_LOAD))
    lines = stage(unique_lines(read(spark, sf_dir, "lineitem")), "lines", release=True)
    customer, dims = read(spark, sf_dir, "customer"), gold_dims(spark, sf_dir)
    replace(dims["product"], first.path("gold/dim_product"))
    replace(dims["territory"], first.path("gold/dim_sales_territory"))
    before, _, changed = _orders(spark, sf_dir)
    path, empty = first.path(FACT), empty_gold(spark, "fact_internet_sales")
    for lake, orders in ((first, before), (second, changed)):
        header = header_of(orders, lines, customer)
        with scratch():
            with scratch() as keep:
                fresh = keep(merge_source(fact_sales(header, detail_of(lines), None, **dims, steps=True), FACT_KEYS))
            touched = FACT_SLOTS.touched(fresh, empty.schema)
            known = last_version(spark, path) is not None
            target = read_snapshot(spark, path, slots=touched) if known else empty
            fact = fact_load(target, fresh, lake.as_of, checked=True)
            replace_slots(fact, path, FACT_SLOTS, touched, sort_by=["CustomerKey", "ProductKey"], cells=4)
        between(lake)
    discard(lines)
    return second


@query(
    "fact_month_slots",
    f"""
WITH {fact_sql(UNIQUE_LINES_SQL, _AFTER_SQL)}
SELECT CAST(OrderDateKey // 100 AS INTEGER) AS month, COUNT(*) AS lines, 1 AS folders,
       CAST(SUM(CAST(SalesAmount AS DECIMAL(19,4))) AS VARCHAR) AS sales,
       bool_or({_DEARER} OR {_NEW}) AS written
FROM (SELECT *, OrderDate AS o_orderdate FROM fact) GROUP BY 1
""",
)
def run_fact_month_slots(spark, sf_dir):
    """Per month: lines, the folders that hold them, and whether the second load
    wrote the month anew."""
    lake = _loaded_fact(spark, sf_dir)
    path = lake.path(FACT)
    written = changed_slots(spark, path, 2)
    month = (F.col("OrderDateKey") / 100).cast("int")
    folder = F.regexp_extract(F.input_file_name(), "(.*)/", 1)
    found = read_snapshot(spark, path).select(month.alias("month"), "SalesAmount", folder.alias("_folder"))
    return found.groupBy("month").agg(
        F.count(F.lit(1)).alias("lines"),
        F.countDistinct("_folder").cast("int").alias("folders"),
        F.sum("SalesAmount").cast("string").alias("sales"),
        F.first(F.col("month").isin(written)).alias("written"),
    )


@query(
    "agg_monthly_touched",
    f"""
WITH {fact_sql(UNIQUE_LINES_SQL, _AFTER_SQL)},
sums AS (
    SELECT year(OrderDate) AS y, month(OrderDate) AS m, n_name, r_name, p_brand,
           COUNT(DISTINCT SalesOrderNumber) AS orders, SUM(OrderQuantity) AS quantity,
           SUM(CAST(SalesAmount AS DECIMAL(19,4))) AS sales, SUM(CAST(Freight AS DECIMAL(19,4))) AS freight,
           bool_or({_DEARER} OR {_NEW}) AS touched
    FROM (SELECT *, OrderDate AS o_orderdate FROM fact) GROUP BY 1, 2, 3, 4, 5
)
SELECT CAST(y AS INTEGER) AS OrderYear, CAST(m AS INTEGER) AS OrderMonth, n_name AS CountryRegionCode,
       COALESCE(p_brand, 'Unknown') AS ProductLine, orders AS TotalOrders, CAST(quantity AS BIGINT) AS TotalQuantitySold,
       CAST(ROUND(sales, 2) AS DOUBLE) AS TotalSalesAmount, CAST(ROUND(freight, 2) AS DOUBLE) AS TotalFreight,
       CASE WHEN bool_or(touched) OVER (PARTITION BY y, m) THEN TIMESTAMP '{SECOND_LOAD}' ELSE TIMESTAMP '{FIRST_LOAD}' END
           AS last_refresh_timestamp
FROM sums
""",
)
def run_agg_monthly_touched(spark, sf_dir):
    """The aggregate after both loads: the second computes its months only."""
    lake = _loaded_fact(spark, sf_dir, between=Lakehouse.load_monthly)
    return read_snapshot(spark, lake.path("gold/agg_monthly_sales")).select(
        "OrderYear", "OrderMonth", "CountryRegionCode", "ProductLine", "TotalOrders", "TotalQuantitySold",
        "TotalSalesAmount", "TotalFreight", "last_refresh_timestamp",
    )


@query(
    "merge_feed_orders",
    f"""
WITH after AS ({_AFTER_SQL})
SELECT *, 'insert' AS _change_type FROM after WHERE {_NEW}
UNION ALL SELECT *, 'update_preimage' FROM orders WHERE {_DEARER}
UNION ALL SELECT *, 'update_postimage' FROM after WHERE {_DEARER}
""",
)
def run_merge_feed(spark, sf_dir):
    """What a merge changes, told by its own plan; equal matches are no change."""
    before, after, _ = _orders(spark, sf_dir)
    return feed_of(merge_upsert(before, after, ["o_orderkey"], feed=True))
