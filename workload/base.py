"""Registry of the checked queries and the tables they read.

The registered queries play the library's pipelines on the driver tables:
orders are order headers, line items order details, parts products, nations
territories, regions territory groups and currencies, and events the versions
of a slowly changing entity (a user).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.money import MONEY
from tidemark.operators.timeline import latest_per_key

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Load times used instead of the clock, so that results repeat.
FIRST_LOAD = "2024-01-15 00:00:00"
SECOND_LOAD = "2024-02-01 00:00:00"


def query(name: str, sql: str | None = None, end_date: bool = False, optional: str = ""):
    """Register a query and the SQL that gives the same rows.

    ``end_date`` marks results with such a column. It is compared as text,
    because the end of time does not fit the timestamps of pandas. ``optional``
    names whole-number columns that may be NULL; they are compared as doubles,
    the form both engines hand out for them.
    """
    doubles = optional.split()
    swaps = [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles]
    if end_date:
        swaps.append("strftime(end_date, '%Y-%m-%d %H:%M:%S.%f') AS end_date")
    if sql is not None and swaps:
        sql = f"SELECT * REPLACE ({', '.join(swaps)}) FROM ({sql})"

    def add(run):
        def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
            found = run(spark, sf_dir)
            return comparable(found.withColumns({c: F.col(c).cast("double") for c in doubles}))

        QUERIES[name] = checked
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Types that both engines hand out alike: decimals and floats as doubles,
    dates and end dates as text, timestamps without a zone."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if f.name == "end_date":
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType)):
            c = c.cast("int")
        out.append(c.alias(f.name))
    return df.select(*out)


@lru_cache(maxsize=256)
def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table; its schema is read once per session."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def unique_lines(lines: DataFrame) -> DataFrame:
    """One line item per order and line number, the greatest by all columns."""
    keys = ["l_orderkey", "l_linenumber"]
    return latest_per_key(lines, keys, [c for c in lines.columns if c not in keys])


UNIQUE_LINES_SQL = """
    SELECT * FROM lineitem
    QUALIFY ROW_NUMBER() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                 l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC, l_shipdate DESC
    ) = 1
"""


def header_of(orders: DataFrame, lines: DataFrame, customer: DataFrame) -> DataFrame:
    """Order headers; sub-total, tax and ship date come from the lines, the
    territory from the customer."""
    price = F.col("l_extendedprice").cast(MONEY)
    totals = lines.groupBy("l_orderkey").agg(
        F.sum(price).cast(MONEY).alias("sub_total"),
        F.sum(F.round(price * F.col("l_tax").cast(MONEY), 4)).cast(MONEY).alias("tax_amt"),
        F.max("l_shipdate").alias("ship_date"),
    )
    who = customer.select("c_custkey", "c_nationkey")
    return (
        orders.join(totals, orders.o_orderkey == totals.l_orderkey)
        .join(who, orders.o_custkey == who.c_custkey, "left")
        .select(
            F.col("o_orderkey").alias("sales_order_id"),
            F.lit(1).cast("tinyint").alias("revision_number"),
            F.col("o_orderdate").alias("order_date"),
            (F.col("o_orderdate") + F.expr("interval 14 days")).alias("due_date"),
            "ship_date",
            (F.col("o_orderstatus") != "P").alias("online_order_flag"),
            F.concat(F.lit("SO"), F.col("o_orderkey").cast("string")).alias("sales_order_number"),
            F.col("o_orderpriority").alias("purchase_order_number"),
            F.col("o_custkey").alias("customer_id"),
            F.col("c_nationkey").alias("territory_id"),
            F.col("c_nationkey").alias("currency_rate_id"),
            "sub_total",
            "tax_amt",
            F.round(F.col("o_totalprice").cast(MONEY) * F.lit("0.025").cast("decimal(4,3)"), 4)
            .cast(MONEY)
            .alias("freight"),
            F.lit(True).alias("is_current"),
        )
    )


def detail_of(lines: DataFrame) -> DataFrame:
    """Order details; the unit price is the line price over the quantity."""
    price, qty = F.col("l_extendedprice").cast(MONEY), F.col("l_quantity").cast("smallint")
    return lines.select(
        F.col("l_orderkey").alias("sales_order_id"),
        F.col("l_linenumber").alias("sales_order_detail_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("special_offer_id"),
        qty.alias("order_qty"),
        F.round(price / F.nullif(qty, F.lit(0)), 4).cast(MONEY).alias("unit_price"),
        F.col("l_discount").cast(MONEY).alias("unit_price_discount"),
        price.alias("line_total"),
        F.col("l_returnflag").alias("carrier_tracking_number"),
    )


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey)


def gold_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dimensions of the fact: parts, customers, suppliers (as promotions),
    nations (as rates and territories) and regions (as currencies)."""
    code = F.substring("r_name", 1, 3)
    land = nations(spark, sf_dir)
    return {
        "product": read(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("ProductKey"),
            F.col("p_retailprice").cast(MONEY).alias("StandardCost"),
            F.col("p_brand").alias("ProductLine"),
        ),
        "customer": read(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("CustomerKey"), F.lit(True).alias("is_current")
        ),
        "promotion": read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("PromotionKey")),
        "currency_rate": land.select(
            F.col("n_nationkey").alias("currency_rate_id"), code.alias("to_currency_code")
        ),
        "currency": read(spark, sf_dir, "region").select(code.alias("currency_code")),
        "territory": land.select(
            F.col("n_nationkey").alias("sales_territory_id"),
            F.col("n_name").alias("sales_country_region_code"),
            F.col("r_name").alias("sales_group_name"),
        ),
    }


def fact_sql(lines: str = "SELECT * FROM lineitem", orders: str = "SELECT * FROM orders") -> str:
    """CTEs up to ``fact``: every column of the fact except the load stamp."""
    return f"""
    li AS ({lines}),
    od AS ({orders}),
    hdr AS (
        SELECT o_orderkey, o_orderdate, o_orderstatus, o_orderpriority, o_custkey, c_nationkey,
               CAST(ROUND(CAST(o_totalprice AS DECIMAL(19,4)) * CAST('0.025' AS DECIMAL(4,3)), 4)
                    AS DECIMAL(19,4)) AS freight,
               sub_total, tax_amt, ship_date
        FROM od
        JOIN (
            SELECT l_orderkey,
                   CAST(SUM(CAST(l_extendedprice AS DECIMAL(19,4))) AS DECIMAL(19,4)) AS sub_total,
                   CAST(SUM(ROUND(CAST(l_extendedprice AS DECIMAL(19,4))
                        * CAST(l_tax AS DECIMAL(19,4)), 4)) AS DECIMAL(19,4)) AS tax_amt,
                   MAX(l_shipdate) AS ship_date
            FROM li GROUP BY l_orderkey
        ) t ON o_orderkey = l_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey
    ),
    det AS (
        SELECT *, CAST(l_quantity AS SMALLINT) AS qty,
               CAST(l_extendedprice AS DECIMAL(19,4)) AS line_total,
               CAST(l_discount AS DECIMAL(19,4)) AS off,
               CAST(CAST((CAST(ROUND(l_extendedprice * 100) AS BIGINT) * 200 + CAST(l_quantity AS BIGINT))
                    // (2 * CAST(l_quantity AS BIGINT)) AS DECIMAL(19,0))
                    * CAST('0.0001' AS DECIMAL(5,4)) AS DECIMAL(19,4)) AS unit_price
        FROM li
    ),
    fact AS (
        SELECT p_partkey AS ProductKey,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS OrderDateKey,
               CAST(strftime(o_orderdate + INTERVAL 14 DAY, '%Y%m%d') AS INTEGER) AS DueDateKey,
               CAST(strftime(ship_date, '%Y%m%d') AS INTEGER) AS ShipDateKey,
               c.c_custkey AS CustomerKey,
               CAST(s_suppkey AS INTEGER) AS PromotionKey,
               substr(r_name, 1, 3) AS CurrencyKey,
               n_nationkey AS SalesTerritoryKey,
               'SO' || o_orderkey AS SalesOrderNumber,
               l_linenumber AS SalesOrderLineNumber,
               1 AS RevisionNumber,
               CAST(qty AS INTEGER) AS OrderQuantity,
               CAST(unit_price AS DOUBLE) AS UnitPrice,
               CAST(line_total AS DOUBLE) AS ExtendedAmount,
               CAST(off AS DOUBLE) AS UnitPriceDiscountPct,
               CAST(ROUND(unit_price * off * qty, 4) AS DOUBLE) AS DiscountAmount,
               CAST(CAST(p_retailprice AS DECIMAL(19,4)) AS DOUBLE) AS ProductStandardCost,
               CAST(CAST(p_retailprice AS DECIMAL(19,4)) * qty AS DOUBLE) AS TotalProductCost,
               CAST(ROUND(unit_price * (1 - off) * qty, 4) AS DOUBLE) AS SalesAmount,
               CAST(ROUND(CAST(CAST(tax_amt AS DOUBLE) * (CAST(line_total AS DOUBLE)
                    / NULLIF(CAST(sub_total AS DOUBLE), 0)) AS DECIMAL(38,6)), 4) AS DOUBLE) AS TaxAmt,
               CAST(ROUND(CAST(CAST(freight AS DOUBLE) * (CAST(line_total AS DOUBLE)
                    / NULLIF(CAST(sub_total AS DOUBLE), 0)) AS DECIMAL(38,6)), 4) AS DOUBLE) AS Freight,
               l_returnflag AS CarrierTrackingNumber,
               o_orderpriority AS CustomerPONumber,
               o_orderdate AS OrderDate,
               o_orderdate + INTERVAL 14 DAY AS DueDate,
               ship_date AS ShipDate,
               p_brand, n_name, r_name
        FROM hdr
        JOIN det ON o_orderkey = l_orderkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN customer c ON o_custkey = c.c_custkey
        LEFT JOIN part ON l_partkey = p_partkey
        LEFT JOIN supplier ON l_suppkey = s_suppkey
        WHERE o_orderstatus <> 'P' AND sub_total > 0
    )"""
