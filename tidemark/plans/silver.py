"""Cleaned tables: what each raw table becomes and how it is loaded."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.money import MONEY
from tidemark.operators.malformed import malformed
from tidemark.operators.conform import ColSpec, conform, with_load_ts
from tidemark.operators.scd2 import LOAD_COL, scd2_apply, undated
from tidemark.operators.timeline import latest_per_key
from tidemark.operators.upsert import new_keys
from tidemark.plans.raw import RAW_COLUMNS

ORDER = "modified_date"

# Names that do not follow the PascalCase -> snake_case rule.
RENAMED = {
    ("sales_salesorderheader", "Status"): "status_code",
    ("sales_salesterritory", "Group"): "territory_group",
    ("sales_specialoffer", "EndDate"): "end_date_offer",
    ("production_productmodelproductdescriptionculture", "Culture"): "culture_id",
}
# Raw columns that the cleaned table leaves out.
DROPPED = {
    "production_productphoto": {"ThumbNailPhoto", "LargePhoto", "rowguid"},
    "production_productproductphoto": {"rowguid"},
    "production_productmodelproductdescriptionculture": {"rowguid"},
}
# Doubles that are no amounts and may be negative.
SIGNED = {("production_product", "Weight")}
# Tables whose timestamps are kept by day.
DAY_GRAIN = {"sales_salesorderheader"}
# The full time of a version where the table keeps the day.
AT = "_at"


@dataclass(frozen=True)
class History:
    """How a history table is kept: its key, the watched columns, the columns
    its files are clustered by, and whether a known key is compared with the
    newest row of a batch only."""

    keys: tuple[str, ...]
    monitored: tuple[str, ...] = ()
    normalise: tuple[str, ...] = ()
    latest_cols: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    newest_only: bool = False


# Key, watched columns and cluster columns of each history table.
HISTORIES = {
    "sales_customer": History(
        keys=("customer_id",),
        monitored=("territory_id", "store_id", "person_id", "account_number"),
        cluster_by=("customer_id", "territory_id"),
    ),
    "sales_salesorderheader": History(
        keys=("sales_order_id",),
        monitored=("sub_total", "status_code", "total_due"),
        cluster_by=("customer_id", "order_date"),
    ),
    "person_person": History(
        keys=("business_entity_id",),
        monitored=("first_name", "last_name", "middle_name", "title", "email_promotion", "person_type"),
        cluster_by=("last_name", "first_name"),
    ),
    "person_address": History(
        keys=("address_id",),
        monitored=("address_line1", "address_line2", "city", "postal_code", "state_province_id"),
        cluster_by=("city", "state_province_id"),
    ),
    "person_stateprovince": History(
        keys=("state_province_id",),
        monitored=("name", "country_region_code", "territory_id", "is_only_state_province_flag"),
        cluster_by=("country_region_code",),
    ),
    "person_countryregion": History(
        keys=("country_region_code",),
        monitored=("name",),
        cluster_by=("country_region_code",),
    ),
    "production_product": History(
        keys=("product_id",),
        monitored=("name", "list_price", "standard_cost", "product_line", "class", "product_subcategory_id"),
        cluster_by=("product_subcategory_id", "product_id"),
        newest_only=True,
    ),
    "production_productcategory": History(
        keys=("product_category_id",),
        monitored=("name",),
        cluster_by=("product_category_id",),
    ),
    "production_productsubcategory": History(
        keys=("product_subcategory_id",),
        monitored=("name", "product_category_id"),
        cluster_by=("product_category_id",),
    ),
    "person_emailaddress": History(
        keys=("business_entity_id", "email_address_id"),
        monitored=("email_address",),
        cluster_by=("business_entity_id", "email_address_id"),
    ),
    "person_personphone": History(
        keys=("business_entity_id", "phone_number_type_id"),
        monitored=("phone_number",),
        cluster_by=("business_entity_id", "phone_number_type_id"),
    ),
    "person_businessentityaddress": History(
        keys=("business_entity_id", "address_type_id"),
        monitored=("address_id",),
        cluster_by=("business_entity_id", "address_type_id"),
        newest_only=True,
    ),
    "production_productdescription": History(
        keys=("product_description_id",),
        monitored=("description",),
        cluster_by=("product_description_id",),
    ),
    "production_productmodel": History(
        keys=("product_model_id",),
        monitored=("name", "catalog_description"),
        normalise=("catalog_description",),
        latest_cols=("instructions",),
        cluster_by=("product_model_id",),
    ),
    "production_unitmeasure": History(
        keys=("unit_measure_code",),
        monitored=("name",),
        cluster_by=("unit_measure_code",),
    ),
    "sales_salesreason": History(
        keys=("sales_reason_id",),
        monitored=("name", "reason_type"),
        cluster_by=("sales_reason_id",),
        newest_only=True,
    ),
    "sales_salesterritory": History(
        keys=("territory_id",),
        monitored=("name", "country_region_code", "territory_group"),
        cluster_by=("country_region_code", "territory_id"),
    ),
    "sales_specialoffer": History(
        keys=("special_offer_id",),
        monitored=(
            "description",
            "discount_pct",
            "type",
            "category",
            "start_date",
            "end_date_offer",
            "min_qty",
            "max_qty",
        ),
        cluster_by=("special_offer_id", "start_date"),
    ),
    "production_productphoto": History(
        keys=("product_photo_id",),
        cluster_by=("product_photo_id",),
    ),
    "production_productproductphoto": History(
        keys=("product_id", "product_photo_id"),
        cluster_by=("product_id", "product_photo_id"),
    ),
    "production_productmodelproductdescriptionculture": History(
        keys=("product_model_id", "product_description_id", "culture_id"),
        cluster_by=("product_model_id", "product_description_id", "culture_id"),
    ),
}

# Insert-only tables and their keys.
INSERT_ONLY = {
    "sales_salesorderdetail": ("sales_order_id", "sales_order_detail_id"),
    "sales_currency": ("currency_code",),
    "sales_currencyrate": ("currency_rate_id",),
    "sales_salesorderheadersalesreason": ("sales_order_id", "sales_reason_id"),
}


def snake_case(name: str) -> str:
    parted = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"([A-Z])([A-Z][a-z])", r"\1_\2", parted).lower()


def column_specs(table: str) -> list[ColSpec]:
    """Cleaned columns of a table: snake_case names; a double is a
    non-negative amount with four decimals unless listed in ``SIGNED``."""
    specs = []
    for column in RAW_COLUMNS[table].split(", "):
        source, kind = column.split(" ")
        if source in DROPPED.get(table, ()):
            continue
        name = RENAMED.get((table, source), snake_case(source))
        if kind == "double":
            specs.append(ColSpec(source, name, MONEY, (table, source) not in SIGNED))
        elif kind == "timestamp" and table in DAY_GRAIN:
            specs.append(ColSpec(source, name, "date"))
        else:
            specs.append(ColSpec(source, name, kind))
    return specs


def silver_schema(table: str) -> str:
    fields = [f"{c.name} {c.kind}" for c in column_specs(table)] + [f"{LOAD_COL} timestamp"]
    if table in HISTORIES:
        fields += ["is_current boolean", "end_date timestamp"]
    return ", ".join(fields)


def empty_silver(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], silver_schema(table))


def clean(raw: DataFrame, table: str, every_version: bool = False) -> DataFrame:
    """The raw rows with a key, under the cleaned names and types. With
    ``every_version`` tables kept by day have the full time as ``AT``."""
    keys = HISTORIES[table].keys if table in HISTORIES else INSERT_ONLY[table]
    if table not in DAY_GRAIN:
        return conform(raw, column_specs(table), keys)
    timed = [*column_specs(table), ColSpec("ModifiedDate", AT, "timestamp")]
    rows = conform(raw, timed, keys)
    if every_version:
        rows = rows.withColumn(AT, F.coalesce(AT, F.col(ORDER).cast("timestamp")))
        return rows.withColumn(ORDER, F.col(AT).cast("date"))
    # Of several versions on one day the last by its full timestamp stays.
    return latest_per_key(rows, [*keys, ORDER], [AT, "rowguid"]).drop(AT)


def unseen_rows(
    target: DataFrame, raw: DataFrame, table: str, as_of: datetime | str | None = None
) -> DataFrame:
    """What a raw batch adds to an insert-only table."""
    batch = with_load_ts(clean(raw, table), as_of=as_of)
    return new_keys(batch, target, INSERT_ONLY[table])


def malformed_rows(raw: DataFrame, table: str, as_of: datetime | str | None = None) -> DataFrame:
    """What does not fit a table in text that was read with its lines."""
    keys = HISTORIES[table].keys if table in HISTORIES else INSERT_ONLY[table]
    return with_load_ts(malformed(raw, column_specs(table), keys), as_of=as_of)


def rejected_rows(raw: DataFrame, table: str, as_of: datetime | str | None = None) -> DataFrame:
    """Rows of a history table that have a key but no readable date."""
    rows = clean(raw, table, every_version=True).drop(AT)
    return with_load_ts(undated(rows, HISTORIES[table].keys, ORDER), as_of=as_of)


def load_silver(
    target: DataFrame,
    raw: DataFrame,
    table: str,
    as_of: datetime | str | None = None,
    null_safe: bool = True,
    hot_rows: int | None = None,
    every_version: bool = False,
    feed: bool = False,
) -> DataFrame:
    """Next state of a cleaned table after a raw batch. Rows without a date are
    left to :func:`rejected_rows`.

    ``every_version`` gives a table kept by day all versions of a day, in the
    order of their full times, which ``end_date`` keeps; else the last of a day.
    ``feed`` tags the rows of a history table (:func:`scd2_apply`).
    """
    if table in INSERT_ONLY:
        return target.unionByName(unseen_rows(target, raw, table, as_of))
    batch, h = clean(raw, table, every_version), HISTORIES[table]
    timed = AT in batch.columns
    # A current row began when the last closed one ended, on the day it keeps.
    began = F.when(F.col("is_current"), F.col(ORDER).cast("timestamp")).otherwise(F.col("end_date"))
    state = scd2_apply(
        target.withColumn(AT, began) if timed else target,
        batch.filter(F.col(ORDER).isNotNull()),
        h.keys,
        h.monitored,
        AT if timed else ORDER,
        ties=["rowguid"] if "rowguid" in batch.columns else [],
        null_safe=null_safe,
        normalise=h.normalise,
        latest_cols=h.latest_cols,
        as_of=as_of,
        hot_rows=hot_rows,
        ends=timed,
        feed=feed,
        newest_only=h.newest_only,
    )
    return state.drop(AT)
