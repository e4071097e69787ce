"""Fact, monthly aggregate and export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.joins import DimSpec, LookUps, star_join
from tidemark.operators.changes import post_images, table_changes
from tidemark.operators.upsert import merge_source, restrict_to_keys
from tidemark.plans.fact import FACT_COLUMNS, FACT_KEYS, changed_orders, fact_load, fact_sales
from tidemark.plans.monthly import SERVING_SCHEMA, agg_monthly_sales
from tidemark.session import discard, scratch, stage, work_path
from tidemark.sources.export import publish, read_export, serving_location
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


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact lines of all online orders."""
    lines = read(spark, sf_dir, "lineitem")
    header = header_of(read(spark, sf_dir, "orders"), lines, read(spark, sf_dir, "customer"))
    return fact_sales(header, detail_of(lines), None, **gold_dims(spark, sf_dir))


_FACT_COLUMNS = ", ".join(FACT_COLUMNS)


@query("fact_sales", f"WITH {fact_sql()} SELECT {_FACT_COLUMNS} FROM fact")
def run_fact_sales(spark, sf_dir):
    return sales_lines(spark, sf_dir)


_MONTHLY_SQL = f"""
WITH {fact_sql()},
sums AS (
    SELECT year(OrderDate) AS OrderYear, month(OrderDate) AS OrderMonth,
           n_name AS CountryRegionCode, r_name AS TerritoryGroup, p_brand,
           COUNT(DISTINCT SalesOrderNumber) AS TotalOrders,
           CAST(SUM(OrderQuantity) AS BIGINT) AS TotalQuantitySold,
           SUM(CAST(SalesAmount AS DECIMAL(19,4))) AS sales,
           SUM(CAST(TotalProductCost AS DECIMAL(19,4))) AS cost,
           SUM(CAST(TaxAmt AS DECIMAL(19,4))) AS tax,
           SUM(CAST(Freight AS DECIMAL(19,4))) AS freight,
           SUM(CAST(DiscountAmount AS DECIMAL(19,4))) AS given
    FROM fact GROUP BY 1, 2, 3, 4, 5
)
SELECT CAST(OrderYear AS INTEGER) AS OrderYear, CAST(OrderMonth AS INTEGER) AS OrderMonth,
       CountryRegionCode, TerritoryGroup, COALESCE(p_brand, 'Unknown') AS ProductLine,
       {{orders}} AS TotalOrders, {{quantity}} AS TotalQuantitySold,
       CAST(ROUND(sales, 2) AS DOUBLE) AS TotalSalesAmount,
       CAST(ROUND(cost, 2) AS DOUBLE) AS TotalProductCost,
       CAST(ROUND(sales - cost, 2) AS DOUBLE) AS GrossProfit,
       CAST(ROUND(CAST(CAST(sales - cost AS DOUBLE) / NULLIF(CAST(sales AS DOUBLE), 0)
            AS DECIMAL(38,8)) * 100, 2) AS DOUBLE) AS GrossMarginPct,
       CAST(ROUND(tax, 2) AS DOUBLE) AS TotalTax,
       CAST(ROUND(freight, 2) AS DOUBLE) AS TotalFreight,
       CAST(ROUND(given, 2) AS DOUBLE) AS TotalDiscountGiven,
       TIMESTAMP '{SECOND_LOAD}' AS last_refresh_timestamp
FROM sums
"""


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = gold_dims(spark, sf_dir)
    lines = sales_lines(spark, sf_dir)
    return agg_monthly_sales(lines, dims["territory"], dims["product"], as_of=SECOND_LOAD)


@query("agg_monthly_sales", _MONTHLY_SQL.format(orders="TotalOrders", quantity="TotalQuantitySold"))
def run_agg_monthly_sales(spark, sf_dir):
    return monthly(spark, sf_dir)


_SERVED_SQL = _MONTHLY_SQL.format(
    orders="CAST(TotalOrders AS INTEGER)", quantity="CAST(TotalQuantitySold AS INTEGER)"
)


@query(
    "export_serving",
    f"""
SELECT * REPLACE (CASE WHEN abs(GrossMarginPct) < 1000 THEN GrossMarginPct END AS GrossMarginPct) FROM ({_SERVED_SQL})
""",
)
def run_export_serving(spark, sf_dir):
    """The second of two exports; margins beyond DECIMAL(5,2) are NULL."""
    path, rows = work_path(spark, "export"), stage(monthly(spark, sf_dir), "monthly")
    publish(rows.limit(0), path, SERVING_SCHEMA)
    publish(rows, path, SERVING_SCHEMA)
    return read_export(spark, serving_location(spark, path), SERVING_SCHEMA)


@query(
    "export_misfits",
    f"""
SELECT 2 AS version, COUNT(*) AS rows, COUNT(CASE WHEN abs(GrossMarginPct) >= 1000 THEN 1 END) AS margins_lost
FROM ({_SERVED_SQL})
""",
)
def run_export_misfits(spark, sf_dir):
    """What the second export says about itself."""
    path, rows = work_path(spark, "export"), stage(monthly(spark, sf_dir), "monthly")
    publish(rows.limit(0), path, SERVING_SCHEMA)
    told = publish(rows, path, SERVING_SCHEMA)
    assert set(told.misfits) <= {"GrossMarginPct"}
    lost = rows.select("GrossMarginPct").groupBy().agg(F.lit(told.misfits.get("GrossMarginPct", 0)).cast("long").alias("margins_lost"))
    return lost.select(F.lit(told.version).alias("version"), F.lit(told.rows).cast("long").alias("rows"), "margins_lost")


@query(
    "look_up_report",
    """
WITH o AS (SELECT o_orderkey, o_custkey FROM orders),
twice AS (SELECT c_custkey FROM customer UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 10 = 0)
SELECT 'o_custkey' AS look_up, COUNT(*) - (SELECT COUNT(*) FROM o) AS multiplied,
       COUNT(*) - COUNT(c_custkey) AS unmatched, 0 AS dropped FROM o LEFT JOIN twice ON o_custkey = c_custkey
UNION ALL
SELECT 'o_orderkey', 0, COUNT(*) - COUNT(p_partkey), COUNT(*) - COUNT(p_partkey)
FROM o LEFT JOIN twice ON o_custkey = c_custkey LEFT JOIN part ON o_orderkey = p_partkey
""",
)
def run_look_up_report(spark, sf_dir):
    """Orders against customers, of whom some are held twice, and then against
    parts by their number, of which most orders have none."""
    customer = read(spark, sf_dir, "customer").select("c_custkey")
    twice = customer.union(customer.filter("c_custkey % 10 = 0"))
    report, part = LookUps(), read(spark, sf_dir, "part")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    specs = [DimSpec(twice, {"o_custkey": "c_custkey"}), DimSpec(part, {"o_orderkey": "p_partkey"}, required=True)]
    stage(star_join(orders, specs, report), "joined")
    told = [(name, t["multiplied"], t["unmatched"], t["dropped"]) for name, t in report.told().items()]
    return spark.createDataFrame(told, "look_up string, multiplied long, unmatched long, dropped long")


# Version 2 of the orders: those from 1998 on are new, and open orders of
# before got another status and price.
_V1_SQL = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'"
_V2_SQL = """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' AND o_orderstatus = 'O' THEN 'F'
                ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' AND o_orderstatus = 'O'
                THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderpriority
    FROM orders
"""


def order_versions(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    orders = read(spark, sf_dir, "orders")
    before = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    closed_now = before & (F.col("o_orderstatus") == "O")
    second = orders.withColumns(
        {
            "o_totalprice": F.when(closed_now, F.col("o_totalprice") + 100).otherwise(F.col("o_totalprice")),
            "o_orderstatus": F.when(closed_now, "F").otherwise(F.col("o_orderstatus")),
        }
    )
    return {1: orders.filter(before), 2: second}


@query(
    "fact_sales_merge",
    f"""
WITH first_load AS (WITH {fact_sql(UNIQUE_LINES_SQL, _V1_SQL)} SELECT {_FACT_COLUMNS} FROM fact),
changed AS (
    SELECT n.o_orderkey FROM ({_V2_SQL}) n LEFT JOIN ({_V1_SQL}) o ON n.o_orderkey = o.o_orderkey
    WHERE n.o_orderstatus <> 'P'
      AND (o.o_orderkey IS NULL OR n.o_orderstatus IS DISTINCT FROM o.o_orderstatus
           OR n.o_totalprice IS DISTINCT FROM o.o_totalprice)
),
second_load AS (
    WITH {fact_sql(UNIQUE_LINES_SQL, _V2_SQL)} SELECT {_FACT_COLUMNS} FROM fact
    WHERE SalesOrderNumber IN (SELECT 'SO' || o_orderkey FROM changed)
)
SELECT *, TIMESTAMP '{SECOND_LOAD}' AS ingestion_timestamp FROM second_load
UNION ALL
SELECT *, TIMESTAMP '{FIRST_LOAD}' FROM first_load f
WHERE NOT EXISTS (SELECT 1 FROM second_load s WHERE s.SalesOrderNumber = f.SalesOrderNumber
                  AND s.SalesOrderLineNumber = f.SalesOrderLineNumber)
""",
)
def run_fact_sales_merge(spark, sf_dir):
    """First load of version 1, then a merge of the orders that version 2 changed."""
    lines = stage(unique_lines(read(spark, sf_dir, "lineitem")), "lines", release=True)
    customer, dims = read(spark, sf_dir, "customer"), gold_dims(spark, sf_dir)
    versions = order_versions(spark, sf_dir)
    headers = {v: header_of(orders, lines, customer) for v, orders in versions.items()}
    feed = table_changes(versions, 2, ["o_orderkey"])
    changes = post_images(feed).select(
        F.col("o_orderkey").alias("sales_order_id"),
        (F.col("o_orderstatus") != "P").alias("online_order_flag"),
    )
    with scratch() as keep:
        fresh = keep(merge_source(fact_sales(headers[2], detail_of(lines), changes, **dims, steps=True), FACT_KEYS))
    with scratch() as keep:
        target = fact_sales(headers[1], detail_of(lines), None, **dims, steps=True).withColumn(
            "ingestion_timestamp", F.lit(FIRST_LOAD).cast("timestamp")
        )
        target = keep(stage(target, "target", release=True))
    discard(lines)
    return fact_load(target, fresh, as_of=SECOND_LOAD, checked=True)


@query(
    "table_changes_orders",
    f"""
WITH v1 AS ({_V1_SQL}), v2 AS ({_V2_SQL}),
     v3 AS (SELECT * FROM v2 WHERE NOT (o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1996-01-01'))
SELECT v2.*, 'insert' AS _change_type, 2 AS _commit_version FROM v2
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM v1)
UNION ALL
SELECT v1.*, 'update_preimage', 2 FROM v1 JOIN v2 USING (o_orderkey)
WHERE (v1.o_orderstatus, v1.o_totalprice) IS DISTINCT FROM (v2.o_orderstatus, v2.o_totalprice)
UNION ALL
SELECT v2.*, 'update_postimage', 2 FROM v1 JOIN v2 USING (o_orderkey)
WHERE (v1.o_orderstatus, v1.o_totalprice) IS DISTINCT FROM (v2.o_orderstatus, v2.o_totalprice)
UNION ALL
SELECT v2.*, 'delete', 3 FROM v2 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM v3)
""",
)
def run_table_changes_orders(spark, sf_dir):
    versions = order_versions(spark, sf_dir)
    early = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    versions[3] = versions[2].filter(~((F.col("o_orderstatus") == "P") & early))
    return table_changes(versions, 2, ["o_orderkey"])


@query(
    "changed_orders_recompute",
    f"""
SELECT l_orderkey AS sales_order_id,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(19,4))) AS DOUBLE) AS sub_total,
       COUNT(*) AS order_lines
FROM lineitem
WHERE l_orderkey IN (
    SELECT n.o_orderkey FROM ({_V2_SQL}) n LEFT JOIN ({_V1_SQL}) o ON n.o_orderkey = o.o_orderkey
    WHERE n.o_orderstatus <> 'P'
      AND (o.o_orderkey IS NULL OR n.o_orderstatus IS DISTINCT FROM o.o_orderstatus
           OR n.o_totalprice IS DISTINCT FROM o.o_totalprice)
)
GROUP BY l_orderkey
""",
)
def run_changed_orders_recompute(spark, sf_dir):
    feed = post_images(table_changes(order_versions(spark, sf_dir), 2, ["o_orderkey"]))
    changes = feed.select(
        F.col("o_orderkey").alias("sales_order_id"),
        (F.col("o_orderstatus") != "P").alias("online_order_flag"),
    )
    detail = detail_of(read(spark, sf_dir, "lineitem"))
    touched = restrict_to_keys(detail, changed_orders(changes), ["sales_order_id"])
    return touched.groupBy("sales_order_id").agg(
        F.sum("line_total").alias("sub_total"), F.count(F.lit(1)).alias("order_lines")
    )
