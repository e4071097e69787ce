"""Cleaned tables that are loaded from the driver tables by their own plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.plans.raw import RAW_COLUMNS
from tidemark.plans.silver import empty_silver, load_silver
from tidemark.session import stage
from workload.base import FIRST_LOAD, SECOND_LOAD, query, read
from workload.files import _as_raw
from workload.history import BATCH_START, TARGET_END, _apply_sql

# Modification dates of the first and the second raw file.
_FIRST, _SECOND = "2024-01-10 08:30:00", "2024-01-25 17:00:00"


def _raw(rows: DataFrame, table: str, values: dict) -> DataFrame:
    """Rows under the raw names of a table, all as text; NULL where not given."""
    names = [c.split(" ")[0] for c in RAW_COLUMNS[table].split(", ")]
    return rows.select(*[values.get(n, F.lit(None)).cast("string").alias(n) for n in names])


@query(
    "silver_photo",
    f"""
SELECT CAST(page_id AS INTEGER) AS product_photo_id, CAST(NULL AS VARCHAR) AS thumbnail_photo_file_name,
       url AS large_photo_file_name, TIMESTAMP '{_FIRST}' AS modified_date,
       TIMESTAMP '{FIRST_LOAD}' AS _ingestion_timestamp, true AS is_current, TIMESTAMP '9999-12-31' AS end_date
FROM pages
""",
    end_date=True,
)
def run_silver_photo(spark, sf_dir):
    """Pages as photos, whose pictures the cleaned table leaves out; of the second
    load, with other names, no photo is new."""
    pages, table = read(spark, sf_dir, "pages"), "production_productphoto"

    def raw(name, at):
        return _raw(pages, table, {
            "ProductPhotoID": F.col("page_id"), "LargePhoto": F.col("html"), "ThumbNailPhoto": F.col("html"),
            "LargePhotoFileName": name, "ModifiedDate": F.lit(at),
        })

    state = load_silver(empty_silver(spark, table), raw(F.col("url"), _FIRST), table, FIRST_LOAD)
    return load_silver(stage(state, "target"), raw(F.upper("url"), _SECOND), table, SECOND_LOAD)


@query(
    "silver_territory",
    f"""
WITH t AS (
    SELECT n_nationkey, n_name, upper(substr(n_name, 1, 2)) AS code, r_name, r_name LIKE 'A%' AS moved
    FROM nation JOIN region ON n_regionkey = r_regionkey
),
rows AS (
    SELECT *, r_name AS g, TIMESTAMP '{_FIRST}' AS modified, TIMESTAMP '{FIRST_LOAD}' AS loaded, NOT moved AS is_current FROM t
    UNION ALL
    SELECT *, 'new ' || r_name, TIMESTAMP '{_SECOND}', TIMESTAMP '{SECOND_LOAD}', true FROM t WHERE moved
)
SELECT n_nationkey AS territory_id, n_name AS name, code AS country_region_code, g AS territory_group,
       CAST(CAST(n_nationkey AS DECIMAL(19,4)) AS DOUBLE) AS sales_ytd, CAST(NULL AS DOUBLE) AS sales_last_year,
       CAST(NULL AS DOUBLE) AS cost_ytd, CAST(NULL AS DOUBLE) AS cost_last_year, CAST(NULL AS VARCHAR) AS rowguid,
       modified AS modified_date, loaded AS _ingestion_timestamp, is_current,
       CASE WHEN is_current THEN TIMESTAMP '9999-12-31' ELSE TIMESTAMP '{_SECOND}' END AS end_date
FROM rows
""",
    end_date=True,
)
def run_silver_territory(spark, sf_dir):
    """Nations as territories, their region under the reserved name Group; regions
    that begin with A are renamed by the second raw file."""
    table = "sales_salesterritory"
    region = read(spark, sf_dir, "region")
    nations = read(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))

    def load(state, group, at, as_of):
        raw = _raw(nations, table, {
            "TerritoryID": F.col("n_nationkey"), "Name": F.col("n_name"),
            "CountryRegionCode": F.upper(F.substring("n_name", 1, 2)), "Group": group,
            "SalesYTD": -F.col("n_nationkey"), "ModifiedDate": F.lit(at),
        })
        return load_silver(state, _as_raw(spark, raw, table), table, as_of)

    state = stage(load(empty_silver(spark, table), F.col("r_name"), _FIRST, FIRST_LOAD), "target")
    renamed = F.when(F.col("r_name").startswith("A"), F.concat(F.lit("new "), "r_name")).otherwise(F.col("r_name"))
    return load(state, renamed, _SECOND, SECOND_LOAD)


@query(
    "silver_sales_reason",
    f"""
SELECT CAST(user_id AS INTEGER) AS sales_reason_id, event_type AS name, props AS reason_type, ts AS modified_date,
       _ingestion_timestamp, is_current, end_date
FROM ({_apply_sql("user_id", ["event_type", "props"], newest_only=True)})
WHERE user_id IS NOT NULL
""",
    end_date=True,
)
def run_silver_sales_reason(spark, sf_dir):
    """Events as versions of sales reasons, of which a load takes the newest only."""
    table = "sales_salesreason"
    raw = _raw(read(spark, sf_dir, "events"), table, {
        "SalesReasonID": F.col("user_id"), "Name": F.col("event_type"),
        "ReasonType": F.col("props"), "ModifiedDate": F.col("ts"),
    })
    old = raw.filter(F.col("ModifiedDate") < TARGET_END)
    new = raw.filter(F.col("ModifiedDate") >= BATCH_START)
    state = stage(load_silver(empty_silver(spark, table), _as_raw(spark, old, table), table, FIRST_LOAD), "target")
    return load_silver(state, _as_raw(spark, new, table), table, SECOND_LOAD)
