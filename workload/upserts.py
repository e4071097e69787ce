"""Insert-if-absent, merge and control table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.changes import merge_watermarks
from tidemark.operators.upsert import insert_if_absent, merge_upsert
from workload.base import FIRST_LOAD, SECOND_LOAD, UNIQUE_LINES_SQL, query, read, unique_lines

SPLIT, OVERLAP = "1998-01-01", "1997-01-01"
LINE_KEYS = ["l_orderkey", "l_linenumber"]


def _day(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _old_and_new(df: DataFrame, date_col: str) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(date_col) < _day(SPLIT)), df.filter(F.col(date_col) >= _day(OVERLAP))


@query(
    "insert_if_absent_orders",
    f"""
SELECT *, 'old' AS loaded FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT}'
UNION ALL
SELECT *, 'new' FROM orders n WHERE o_orderdate >= TIMESTAMP '{OVERLAP}'
AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = n.o_orderkey
                AND o.o_orderdate < TIMESTAMP '{SPLIT}')
""",
)
def run_insert_if_absent(spark, sf_dir):
    old, new = _old_and_new(read(spark, sf_dir, "orders"), "o_orderdate")
    return insert_if_absent(
        old.withColumn("loaded", F.lit("old")), new.withColumn("loaded", F.lit("new")), ["o_orderkey"]
    )


@query(
    "insert_if_absent_composite",
    f"""
WITH old AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{SPLIT}'),
     new AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{OVERLAP}')
SELECT * FROM old
UNION ALL
SELECT * FROM new n WHERE NOT EXISTS (
    SELECT 1 FROM old o WHERE o.l_orderkey = n.l_orderkey AND o.l_linenumber = n.l_linenumber)
""",
)
def run_insert_if_absent_composite(spark, sf_dir):
    old, new = _old_and_new(read(spark, sf_dir, "lineitem"), "l_shipdate")
    return insert_if_absent(old, new, LINE_KEYS)


@query(
    "merge_upsert_orders",
    f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate >= TIMESTAMP '{OVERLAP}' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderdate >= TIMESTAMP '{OVERLAP}' THEN o_totalprice * 2 ELSE o_totalprice END
           AS o_totalprice,
       o_orderdate,
       CASE WHEN o_orderdate >= TIMESTAMP '{SPLIT}' THEN 'changed' ELSE o_orderpriority END
           AS o_orderpriority,
       CASE WHEN o_orderdate >= TIMESTAMP '{OVERLAP}' THEN TIMESTAMP '{SECOND_LOAD}'
            ELSE TIMESTAMP '{FIRST_LOAD}' END AS ingestion_timestamp
FROM orders
""",
)
def run_merge_upsert_orders(spark, sf_dir):
    """Status and price are updated; the priority is set on insert only."""
    old, new = _old_and_new(read(spark, sf_dir, "orders"), "o_orderdate")
    old = old.withColumn("ingestion_timestamp", F.lit(FIRST_LOAD).cast("timestamp"))
    new = new.withColumns(
        {
            "o_orderstatus": F.lit("X"),
            "o_totalprice": F.col("o_totalprice") * 2,
            "o_orderpriority": F.lit("changed"),
        }
    )
    stamp = {"ingestion_timestamp": F.lit(SECOND_LOAD).cast("timestamp")}
    return merge_upsert(old, new, ["o_orderkey"], ["o_orderstatus", "o_totalprice"], stamp=stamp)


@query(
    "merge_upsert_lines",
    f"""
WITH u AS ({UNIQUE_LINES_SQL}),
     old AS (SELECT * FROM u WHERE l_shipdate < TIMESTAMP '{SPLIT}'),
     new AS (SELECT * REPLACE (l_quantity + 1 AS l_quantity, 'U' AS l_linestatus) FROM u
             WHERE l_shipdate >= TIMESTAMP '{OVERLAP}')
SELECT * FROM new
UNION ALL
SELECT * FROM old o WHERE NOT EXISTS (
    SELECT 1 FROM new n WHERE n.l_orderkey = o.l_orderkey AND n.l_linenumber = o.l_linenumber)
""",
)
def run_merge_upsert_lines(spark, sf_dir):
    old, new = _old_and_new(unique_lines(read(spark, sf_dir, "lineitem")), "l_shipdate")
    new = new.withColumns({"l_quantity": F.col("l_quantity") + 1, "l_linestatus": F.lit("U")})
    return merge_upsert(old, new, LINE_KEYS)


@query(
    "merge_update_only",
    f"""
SELECT * REPLACE (CASE WHEN o_orderdate >= TIMESTAMP '{OVERLAP}' THEN 'X' ELSE o_orderstatus END
                  AS o_orderstatus)
FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT}'
""",
)
def run_merge_update_only(spark, sf_dir):
    old, new = _old_and_new(read(spark, sf_dir, "orders"), "o_orderdate")
    new = new.withColumn("o_orderstatus", F.lit("X"))
    return merge_upsert(old, new, ["o_orderkey"], ["o_orderstatus"], insert=False)


@query(
    "watermark_upsert",
    f"""
WITH old AS (
    SELECT event_type AS table_name, CAST(COUNT(*) AS INTEGER) AS last_version,
           TIMESTAMP '{FIRST_LOAD}' AS last_run_timestamp
    FROM events WHERE ts < TIMESTAMP '2024-01-15' AND event_type <> 'error' GROUP BY event_type
),
new AS (
    SELECT event_type AS table_name, CAST(COUNT(*) AS INTEGER) AS last_version,
           TIMESTAMP '{SECOND_LOAD}' AS last_run_timestamp
    FROM events WHERE event_type <> 'view' GROUP BY event_type
)
SELECT * FROM new UNION ALL SELECT * FROM old WHERE table_name NOT IN (SELECT table_name FROM new)
""",
)
def run_watermark_upsert(spark, sf_dir):
    """One control row per event type; its version is the number of its events."""
    events = read(spark, sf_dir, "events")

    def control(rows: DataFrame, as_of: str) -> DataFrame:
        return rows.groupBy(F.col("event_type").alias("table_name")).agg(
            F.count(F.lit(1)).cast("int").alias("last_version"),
            F.lit(as_of).cast("timestamp").alias("last_run_timestamp"),
        )

    early = F.col("ts") < _day("2024-01-15")
    old = control(events.filter(early & (F.col("event_type") != "error")), FIRST_LOAD)
    return merge_watermarks(old, control(events.filter(F.col("event_type") != "view"), SECOND_LOAD))
