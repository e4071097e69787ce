"""Loads of the simple dimensions and the calendar."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.calendar import date_key, fiscal_parts
from tidemark.operators.scd2 import current, load_stamp
from tidemark.operators.upsert import insert_if_absent

# Default span of the calendar.
FIRST_DAY, LAST_DAY = date(2010, 1, 1), date(2030, 12, 31)

As_of = datetime | str | None


def calendar_days(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day of the one-row frame ``bounds``."""
    days = F.sequence(F.col(first).cast("date"), F.col(last).cast("date"), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("date"))


def describe_days(days: DataFrame, fiscal_start: int = 7) -> DataFrame:
    d = F.col("date")
    weekday = F.dayofweek(d)  # 1 = Sunday
    return days.select(
        date_key(d).cast("int").alias("date_sk"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.day(d).alias("day"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        weekday.between(2, 6).alias("is_weekday"),
        weekday.isin(1, 7).alias("is_weekend"),
        (d == F.last_day(d)).alias("is_last_day_of_month"),
        *[part.alias(name) for name, part in fiscal_parts(d, fiscal_start).items()],
    )


def dim_date(
    spark: SparkSession, start: date = FIRST_DAY, end: date = LAST_DAY, fiscal_start: int = 7
) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    bounds = spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    return describe_days(calendar_days(bounds, "first", "last"), fiscal_start)


def load_dim_currency(target: DataFrame, silver: DataFrame, as_of: As_of = None) -> DataFrame:
    source = silver.filter(F.col("currency_code").isNotNull()).select(
        "currency_code",
        F.col("name").alias("currency_name"),
        load_stamp(as_of).alias("ingestion_timestamp"),
    )
    return insert_if_absent(target, source, ["currency_code"], one_per_key=True)


def load_dim_geography(
    target: DataFrame, address: DataFrame, state: DataFrame, country: DataFrame, as_of: As_of = None
) -> DataFrame:
    """Current addresses with their state and country, by address id."""
    countries = current(country).select("country_region_code", F.col("name").alias("country_name"))
    states = (
        current(state)
        .filter(F.col("state_province_code").isNotNull() & F.col("country_region_code").isNotNull())
        .select(
            "state_province_id",
            "state_province_code",
            F.col("name").alias("state_name"),
            "country_region_code",
            "territory_id",
        )
        .join(countries, "country_region_code")
    )
    source = (
        current(address)
        .filter(F.col("address_id").isNotNull())
        .join(states, "state_province_id")
        .select(
            F.col("address_id").alias("GeographyKey"),
            F.col("city").alias("City"),
            F.col("state_province_code").alias("StateProvinceCode"),
            F.col("state_name").alias("StateProvinceName"),
            F.col("country_region_code").alias("CountryRegionCode"),
            F.col("country_name").alias("CountryRegionName"),
            F.col("postal_code").alias("PostalCode"),
            F.col("territory_id").alias("SalesTerritoryKey"),
            load_stamp(as_of).alias("ingestion_timestamp"),
        )
    )
    return insert_if_absent(target, source, ["GeographyKey"], one_per_key=True)


def load_dim_territory(target: DataFrame, silver: DataFrame, as_of: As_of = None) -> DataFrame:
    source = current(silver).filter(F.col("territory_id").isNotNull()).select(
        F.col("territory_id").alias("sales_territory_id"),
        F.col("name").alias("sales_territory_name"),
        F.col("country_region_code").alias("sales_country_region_code"),
        F.col("territory_group").alias("sales_group_name"),
        load_stamp(as_of).alias("ingestion_timestamp"),
    )
    return insert_if_absent(target, source, ["sales_territory_id"], one_per_key=True)


def load_dim_category(target: DataFrame, silver: DataFrame, as_of: As_of = None) -> DataFrame:
    source = current(silver).filter(F.col("product_category_id").isNotNull()).select(
        F.col("product_category_id").alias("ProductCategoryKey"),
        F.col("name").alias("ProductCategoryName"),
        load_stamp(as_of).alias("IngestionTimestamp"),
    )
    return insert_if_absent(target, source, ["ProductCategoryKey"], one_per_key=True)


def load_dim_subcategory(target: DataFrame, silver: DataFrame, as_of: As_of = None) -> DataFrame:
    source = current(silver).filter(F.col("product_subcategory_id").isNotNull()).select(
        F.col("product_subcategory_id").alias("ProductSubCategoryKey"),
        F.col("name").alias("ProductSubCategoryName"),
        F.col("product_category_id").alias("ProductCategoryKey"),
        load_stamp(as_of).alias("IngestionTimestamp"),
    )
    return insert_if_absent(target, source, ["ProductSubCategoryKey"], one_per_key=True)


def load_dim_promotion(target: DataFrame, silver: DataFrame) -> DataFrame:
    """Promotions with dates instead of timestamps and a float discount."""
    source = current(silver).filter(F.col("special_offer_id").isNotNull()).select(
        F.col("special_offer_id").alias("PromotionKey"),
        F.col("description").alias("PromotionDescription"),
        F.col("discount_pct").cast("float").alias("DiscountPct"),
        F.col("type").alias("PromotionType"),
        F.col("category").alias("PromotionCategory"),
        F.col("start_date").cast("date").alias("StartDate"),
        F.col("end_date_offer").cast("date").alias("EndDate"),
        F.col("min_qty").alias("MinQty"),
        F.col("max_qty").alias("MaxQty"),
        "_ingestion_timestamp",
    )
    return insert_if_absent(target, source, ["PromotionKey"], one_per_key=True)


def load_dim_reason(target: DataFrame, silver: DataFrame, as_of: As_of = None) -> DataFrame:
    """All versions of the sales reasons by id, name and type, each once; the
    state says whether it is the current one. A version whose state changes is
    updated, so that a closed reason does not stay open beside itself."""
    key = F.struct("sales_reason_id", "sales_reason_name", "sales_reason_type")
    source = (
        silver.filter(F.col("sales_reason_id").isNotNull())
        .groupBy("sales_reason_id", F.col("name").alias("sales_reason_name"), F.col("reason_type").alias("sales_reason_type"))
        .agg(F.max("is_current").alias("sales_reason_state"))
    )
    source = source.withColumn("ingestion_timestamp", load_stamp(as_of))
    old = target.withColumn("_known", F.lit(True))
    both = source.select(key.alias("_key"), "sales_reason_state", "ingestion_timestamp").alias("s").join(
        old.select(key.alias("_key"), "sales_reason_state", "ingestion_timestamp", "_known").alias("t"),
        F.col("s._key").eqNullSafe(F.col("t._key")),
        "full",
    )
    same = F.col("s._key").isNull() | F.col("s.sales_reason_state").eqNullSafe(F.col("t.sales_reason_state"))
    keep = F.col("_known").isNotNull() & same
    state, stamp = ("sales_reason_state", "ingestion_timestamp")
    new = both.select(
        F.coalesce("s._key", "t._key").alias("_key"),
        *[F.when(keep, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in (state, stamp)],
    )
    return new.select(*[F.col(c) if c in (state, stamp) else F.col(f"_key.{c}") for c in target.columns])
