"""Reading, casting, writing and counting."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.text import norm_xml, strip_delims
from tidemark.operators.changes import empty_control, set_watermark
from tidemark.operators.checks import count_tables, probe_text
from tidemark.operators.conform import ColSpec, conform
from tidemark.operators.malformed import well_formed
from tidemark.operators.layout import cluster_write, write_partitioned
from tidemark.plans.raw import RAW_COLUMNS, read_raw
from tidemark.plans.silver import empty_silver, load_silver, malformed_rows
from tidemark.session import stage, work_path
from tidemark.sources.delimited import CONTROL_A, read_delimited, write_delimited
from tidemark.sources.jdbc import extract
from tidemark.sources.snapshots import append, read_snapshot, replace, snapshot_log
from tidemark.streaming.incremental import pull_changes
from workload.base import FIRST_LOAD, SECOND_LOAD, TABLES, UNIQUE_LINES_SQL, query, read, unique_lines
from workload.sales import _V1_SQL, _V2_SQL, order_versions


@query(
    "conform_lineitem",
    """
SELECT TRY_CAST(l_orderkey AS INTEGER) AS sales_order_id, l_linenumber AS line,
       TRY_CAST(l_quantity AS INTEGER) AS order_qty,
       CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS DOUBLE) AS line_total,
       CAST(CAST(l_discount AS DECIMAL(19,4)) AS DOUBLE) AS discount,
       strftime(l_shipdate, '%Y-%m-%d') AS ship_date, l_linestatus = 'O' AS is_open
FROM lineitem WHERE l_orderkey IS NOT NULL
""",
)
def run_conform_lineitem(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").withColumn("open", F.col("l_linestatus") == "O")
    spec = [
        ColSpec("l_orderkey", "sales_order_id", "int"),
        ColSpec("l_linenumber", "line", "tinyint"),
        ColSpec("l_quantity", "order_qty", "smallint"),
        ColSpec("l_extendedprice", "line_total", "decimal(19,4)", abs=True),
        ColSpec("l_discount", "discount", "decimal(19,4)", abs=True),
        ColSpec("l_shipdate", "ship_date", "date"),
        ColSpec("open", "is_open", "boolean"),
    ]
    return conform(lines, spec, ["sales_order_id"])


@query(
    "conform_customer",
    """
SELECT CAST(c_custkey AS INTEGER) AS customer_id,
       CAST(ABS(CAST(c_acctbal AS DECIMAL(19,4))) AS DOUBLE) AS balance,
       CAST(CASE WHEN c_custkey BETWEEN -128 AND 127 THEN c_custkey END AS INTEGER) AS small_id,
       TRY_CAST(c_mktsegment AS INTEGER) AS no_number
FROM customer
""",
    optional="small_id no_number",
)
def run_conform_customer(spark, sf_dir):
    """Negative balances lose their sign; what does not fit its type is NULL."""
    spec = [
        ColSpec("c_custkey", "customer_id", "int"),
        ColSpec("c_acctbal", "balance", "decimal(19,4)", abs=True),
        ColSpec("c_custkey", "small_id", "tinyint"),
        ColSpec("c_mktsegment", "no_number", "int"),
    ]
    return conform(read(spark, sf_dir, "customer"), spec, ["customer_id"])


@query(
    "delimited_roundtrip",
    """
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment || ', "Inc"' END AS c_mktsegment
FROM customer
""",
)
def run_delimited_roundtrip(spark, sf_dir):
    """Comma-delimited text with NULLs, commas, quotes and a stripped line break."""
    customer = read(spark, sf_dir, "customer")
    segment = F.concat("c_mktsegment", F.lit(', "Inc"\n'))
    customer = customer.withColumn(
        "c_mktsegment", F.when(F.col("c_mktsegment") != "BUILDING", segment)
    )
    path = work_path(spark, "text")
    extract(customer, path, strip=["c_mktsegment"])
    return read_delimited(spark, path, customer.schema)


@query(
    "control_a_roundtrip",
    r"SELECT page_id, url, regexp_replace(html, '[\n\r\x01]', '', 'g') AS html FROM pages",
)
def run_control_a_roundtrip(spark, sf_dir):
    """Whole pages, with their quotes and commas, through control-A text."""
    pages = read(spark, sf_dir, "pages")
    path = work_path(spark, "text")
    write_delimited(strip_delims(pages, ["html"]), path, CONTROL_A)
    return read_delimited(spark, path, pages.schema, CONTROL_A)


@query(
    "count_tables",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES),
)
def run_count_tables(spark, sf_dir):
    return count_tables({t: read(spark, sf_dir, t) for t in TABLES})


@query(
    "probe_text",
    """
SELECT page_id, url, CAST(length(html) AS INTEGER) AS chars FROM pages
WHERE html IS NOT NULL ORDER BY page_id LIMIT 5
""",
)
def run_probe_text(spark, sf_dir):
    return probe_text(read(spark, sf_dir, "pages"), ["page_id", "url"], "html", order=["page_id"])


@query(
    "xml_gap_compare",
    r"""
WITH n AS (SELECT page_id, html, regexp_replace(trim(COALESCE(html, '')), '>\s+<', '><', 'g') AS norm FROM pages)
SELECT page_id, CAST(length(norm) AS INTEGER) AS chars, md5(norm) AS digest, norm <> html AS has_gaps FROM n
""",
)
def run_xml_gap_compare(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").withColumn("norm", norm_xml(F.col("html")))
    return pages.select(
        "page_id",
        F.length("norm").alias("chars"),
        F.md5("norm").alias("digest"),
        (F.col("norm") != F.col("html")).alias("has_gaps"),
    )


@query("cluster_write", "SELECT * FROM lineitem")
def run_cluster_write(spark, sf_dir):
    path = work_path(spark, "clustered")
    cluster_write(read(spark, sf_dir, "lineitem"), path, ["l_partkey", "l_shipdate"], files=8)
    return spark.read.parquet(path)


@query(
    "partitioned_read",
    """
SELECT *, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS order_month
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1999-03-01'
""",
)
def run_partitioned_read(spark, sf_dir):
    """Written by month, read by month: only the asked-for folders are opened."""
    month = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    path = work_path(spark, "by-month")
    write_partitioned(read(spark, sf_dir, "orders").withColumn("order_month", month), path, ["order_month"])
    return spark.read.parquet(path).filter(F.col("order_month").between(199803, 199902))


@query("snapshot_append", "SELECT * FROM orders")
def run_snapshot_append(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    before = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    path = work_path(spark, "table")
    replace(orders.filter(before), path)
    append(orders.filter(~before), path)
    return read_snapshot(spark, path)


@query(
    "snapshot_log",
    """
SELECT 1 AS version, COUNT(*) AS rows, 'replace' AS note FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL SELECT 2, COUNT(*), 'append' FROM orders
UNION ALL SELECT 3, COUNT(*), 'replace' FROM lineitem
""",
)
def run_snapshot_log(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    before = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    path = work_path(spark, "table")
    replace(orders.filter(before), path)
    append(orders.filter(~before), path)
    replace(read(spark, sf_dir, "lineitem"), path)
    return snapshot_log(spark, path).select("version", "rows", "note")


def _stored_orders(spark, sf_dir) -> str:
    """Three stored versions: orders before 1998, the later ones appended, and
    all without the early pending ones."""
    orders = read(spark, sf_dir, "orders")
    before = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    early = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    path = work_path(spark, "table")
    replace(orders.filter(before), path)
    append(orders.filter(~before), path)
    replace(orders.filter(~((F.col("o_orderstatus") == "P") & early)), path)
    return path


def _pulled(spark, sf_dir):
    control = set_watermark(empty_control(spark), "orders", 1, FIRST_LOAD)
    return pull_changes(spark, control, "orders", _stored_orders(spark, sf_dir), ["o_orderkey"], SECOND_LOAD)


@query(
    "table_changes_stored",
    """
SELECT *, 'insert' AS _change_type, 2 AS _commit_version FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
UNION ALL
SELECT *, 'delete', 3 FROM orders WHERE o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1996-01-01'
""",
)
def run_table_changes_stored(spark, sf_dir):
    return _pulled(spark, sf_dir)[0]


@query(
    "watermark_set",
    f"""
SELECT 'orders' AS table_name, 3 AS last_version, TIMESTAMP '{SECOND_LOAD}' AS last_run_timestamp, COUNT(*) AS changes
FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01' OR o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1996-01-01'
""",
)
def run_watermark_set(spark, sf_dir):
    """The control row after the changes were counted."""
    feed, control = _pulled(spark, sf_dir)
    # One row; the counts are combined before they meet.
    told = feed.groupBy(F.lit("orders").alias("table_name")).agg(F.count(F.lit(1)).alias("changes"))
    return control.join(told, "table_name")


def _raw_header(orders: DataFrame, years_later: int) -> DataFrame:
    """Orders as the 26 text columns of the raw header file."""
    changed = F.col("o_orderdate") + F.expr(f"interval {years_later} year")
    status = F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "P", 3).otherwise(5)
    values = {
        "SalesOrderID": F.col("o_orderkey"),
        "RevisionNumber": F.lit(1),
        "OrderDate": F.col("o_orderdate"),
        "Status": status,
        "OnlineOrderFlag": F.col("o_orderstatus") != "P",
        "SalesOrderNumber": F.concat(F.lit("SO"), F.col("o_orderkey").cast("string")),
        "PurchaseOrderNumber": F.concat(F.lit("a, "), F.col("o_orderpriority")),
        "CustomerID": F.col("o_custkey"),
        "SubTotal": -F.col("o_totalprice"),
        "TotalDue": F.col("o_totalprice"),
        "rowguid": F.col("o_orderkey"),
        "ModifiedDate": changed,
    }
    names = [c.split(" ")[0] for c in RAW_COLUMNS["sales_salesorderheader"].split(", ")]
    return orders.select(*[values.get(n, F.lit(None)).cast("string").alias(n) for n in names])


def _as_raw(spark, df: DataFrame, table: str) -> DataFrame:
    path = work_path(spark, "raw")
    write_delimited(df, path)
    return read_raw(spark, table, path)


@query(
    "silver_order_header",
    f"""
WITH v1 AS ({_V1_SQL}), v2 AS ({_V2_SQL}),
changed AS (
    SELECT v2.o_orderkey FROM v1 JOIN v2 USING (o_orderkey)
    WHERE (v1.o_orderstatus, v1.o_totalprice) IS DISTINCT FROM (v2.o_orderstatus, v2.o_totalprice)
),
rows AS (
    SELECT *, o_orderdate AS modified, TIMESTAMP '{FIRST_LOAD}' AS loaded,
           o_orderkey NOT IN (SELECT o_orderkey FROM changed) AS is_current FROM v1
    UNION ALL
    SELECT *, o_orderdate + INTERVAL 1 YEAR, TIMESTAMP '{SECOND_LOAD}', true FROM v2
    WHERE o_orderkey IN (SELECT o_orderkey FROM changed) OR o_orderkey NOT IN (SELECT o_orderkey FROM v1)
)
SELECT CAST(o_orderkey AS INTEGER) AS sales_order_id, 1 AS revision_number,
       strftime(o_orderdate, '%Y-%m-%d') AS order_date, CAST(NULL AS VARCHAR) AS due_date,
       CAST(NULL AS VARCHAR) AS ship_date,
       CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 3 ELSE 5 END AS status_code,
       o_orderstatus <> 'P' AS online_order_flag, 'SO' || o_orderkey AS sales_order_number,
       'a, ' || o_orderpriority AS purchase_order_number, CAST(NULL AS VARCHAR) AS account_number,
       CAST(o_custkey AS INTEGER) AS customer_id, CAST(NULL AS INTEGER) AS sales_person_id,
       CAST(NULL AS INTEGER) AS territory_id, CAST(NULL AS INTEGER) AS bill_to_address_id,
       CAST(NULL AS INTEGER) AS ship_to_address_id, CAST(NULL AS INTEGER) AS ship_method_id,
       CAST(NULL AS INTEGER) AS credit_card_id, CAST(NULL AS VARCHAR) AS credit_card_approval_code,
       CAST(NULL AS INTEGER) AS currency_rate_id,
       CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS DOUBLE) AS sub_total,
       CAST(NULL AS DOUBLE) AS tax_amt, CAST(NULL AS DOUBLE) AS freight,
       CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS DOUBLE) AS total_due,
       CAST(NULL AS VARCHAR) AS comment, CAST(o_orderkey AS VARCHAR) AS rowguid,
       strftime(modified, '%Y-%m-%d') AS modified_date, loaded AS _ingestion_timestamp, is_current,
       CASE WHEN is_current THEN TIMESTAMP '9999-12-31' ELSE o_orderdate + INTERVAL 1 YEAR END AS end_date
FROM rows
""",
    end_date=True,
    optional="sales_person_id territory_id bill_to_address_id ship_to_address_id ship_method_id "
    "credit_card_id currency_rate_id",
)
def run_silver_order_header(spark, sf_dir):
    """Two raw text files loaded one after the other into the order header history."""
    versions, table = order_versions(spark, sf_dir), "sales_salesorderheader"
    first = _as_raw(spark, _raw_header(versions[1], 0), table)
    second = _as_raw(spark, _raw_header(versions[2], 1), table)
    state = load_silver(empty_silver(spark, table), first, table, FIRST_LOAD, every_version=True)
    return load_silver(stage(state, "target"), second, table, SECOND_LOAD, every_version=True)


@query(
    "silver_order_detail",
    f"""
SELECT CAST(l_orderkey AS INTEGER) AS sales_order_id, l_linenumber AS sales_order_detail_id,
       CAST(NULL AS VARCHAR) AS carrier_tracking_number, CAST(l_quantity AS INTEGER) AS order_qty,
       CAST(l_partkey AS INTEGER) AS product_id, CAST(l_suppkey AS INTEGER) AS special_offer_id,
       l_extendedprice AS unit_price, l_discount AS unit_price_discount, l_extendedprice AS line_total,
       l_returnflag AS rowguid, l_shipdate AS modified_date,
       CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN TIMESTAMP '{FIRST_LOAD}'
            ELSE TIMESTAMP '{SECOND_LOAD}' END AS _ingestion_timestamp
FROM ({UNIQUE_LINES_SQL})
""",
)
def run_silver_order_detail(spark, sf_dir):
    """Raw order lines: those shipped before 1998 first, then all of them."""
    lines, table = unique_lines(read(spark, sf_dir, "lineitem")), "sales_salesorderdetail"
    values = {
        "SalesOrderID": F.col("l_orderkey"),
        "SalesOrderDetailID": F.col("l_linenumber"),
        "OrderQty": F.col("l_quantity").cast("int"),
        "ProductID": F.col("l_partkey"),
        "SpecialOfferID": F.col("l_suppkey"),
        "UnitPrice": F.col("l_extendedprice"),
        "UnitPriceDiscount": F.col("l_discount"),
        "LineTotal": -F.col("l_extendedprice"),
        "rowguid": F.col("l_returnflag"),
        "ModifiedDate": F.col("l_shipdate"),
    }
    names = [c.split(" ")[0] for c in RAW_COLUMNS[table].split(", ")]
    raw = lines.select(*[values.get(n, F.lit(None)).cast("string").alias(n) for n in names])
    early = raw.filter(F.col("ModifiedDate") < "1998-01-01")
    state = load_silver(empty_silver(spark, table), _as_raw(spark, early, table), table, FIRST_LOAD)
    return load_silver(stage(state, "target"), _as_raw(spark, raw, table), table, SECOND_LOAD)


# Lines of the raw order header that are spoilt, by order key.
_SPOILT = {"few": "o_orderkey % 97 = 1", "many": "o_orderkey % 89 = 2", "key": "o_orderkey % 83 = 3", "date": "o_orderkey % 79 = 4"}
_REASON_SQL = f"""
CASE WHEN {_SPOILT["few"]} OR {_SPOILT["many"]} THEN 'number of fields'
     WHEN {_SPOILT["key"]} THEN 'no sales_order_id' WHEN {_SPOILT["date"]} THEN 'order_date is no date' END
"""


def _spoilt_header(spark, sf_dir) -> DataFrame:
    raw = _raw_header(read(spark, sf_dir, "orders"), 0)
    is_ = {name: F.expr(test.replace("o_orderkey", "cast(rowguid as bigint)")) for name, test in _SPOILT.items()}
    fields = {"SalesOrderID": F.when(~is_["key"], F.col("SalesOrderID")), "OrderDate": F.when(is_["date"], "soon").otherwise(F.col("OrderDate"))}
    # Quoted, as the purchase order numbers hold commas.
    told = [F.coalesce(F.concat(F.lit('"'), fields.get(c, F.col(c)), F.lit('"')), F.lit("null")) for c in raw.columns]
    whole, fewer = F.concat_ws(",", *told), F.concat_ws(",", *told[:-1])
    return raw.select(F.when(is_["few"], fewer).when(is_["many"], F.concat(whole, F.lit(",more"))).otherwise(whole).alias("value"))


def _read_spoilt(spark, sf_dir) -> DataFrame:
    path, table = work_path(spark, "raw"), "sales_salesorderheader"
    _spoilt_header(spark, sf_dir).write.text(path)
    return read_raw(spark, table, path, lines=True)


@query(
    "malformed_lines",
    f"""
SELECT {_REASON_SQL} AS reason, COUNT(*) AS lines, bool_and({_SPOILT["date"]} AND NOT {_SPOILT["few"]}) AS kept
FROM orders WHERE {_REASON_SQL} IS NOT NULL GROUP BY 1
""",
)
def run_malformed_lines(spark, sf_dir):
    """Planted bad lines in the raw order header, counted by reason."""
    found = malformed_rows(_read_spoilt(spark, sf_dir), "sales_salesorderheader", FIRST_LOAD)
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"), F.every("kept").alias("kept"))


@query(
    "well_formed_orders",
    f"""
SELECT CAST(o_orderkey AS INTEGER) AS sales_order_id,
       CASE WHEN NOT ({_SPOILT["date"]}) THEN strftime(o_orderdate, '%Y-%m-%d') END AS order_date
FROM orders WHERE COALESCE({_REASON_SQL}, '') NOT IN ('number of fields', 'no sales_order_id')
""",
)
def run_well_formed_orders(spark, sf_dir):
    """What of the same lines reaches the history."""
    raw, table = stage(well_formed(_read_spoilt(spark, sf_dir)), "raw"), "sales_salesorderheader"
    return load_silver(empty_silver(spark, table), raw, table, FIRST_LOAD).select("sales_order_id", "order_date")
