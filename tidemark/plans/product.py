"""Product dimension: current rows and history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.joins import DimSpec, star_join
from tidemark.operators.scd2 import LOAD_COL, closed, current, load_stamp
from tidemark.operators.timeline import latest_per_key
from tidemark.operators.upsert import insert_if_absent, merge_upsert


def product_enriched(
    product: DataFrame, model: DataFrame, link: DataFrame, photo: DataFrame
) -> DataFrame:
    """Every product version with the names of its model and photo.

    A product with several photos takes the one with the greatest id, so that
    the join never multiplies products.
    """
    one_photo = latest_per_key(current(link), ["product_id"], ["product_photo_id"])
    found = star_join(
        product,
        [
            DimSpec(model, {"product_model_id": "product_model_id"}, {"ModelName": "name"}, current_only=True),
            DimSpec(one_photo, {"product_id": "product_id"}, {"_photo_id": "product_photo_id"}),
            DimSpec(photo, {"_photo_id": "product_photo_id"}, {"LargePhoto": "large_photo_file_name"}, current_only=True),
        ],
    )
    return found.select(
        F.col("product_id").alias("ProductKey"),
        F.col("product_number").alias("ProductNumber"),
        F.col("product_subcategory_id").alias("ProductSubcategoryKey"),
        F.col("size_unit_measure_code").alias("SizeUnitMeasureCode"),
        F.col("weight_unit_measure_code").alias("WeightUnitMeasureCode"),
        F.col("name").alias("ProductName"),
        F.col("standard_cost").alias("StandardCost"),
        F.col("finished_goods_flag").alias("FinishedGoodsFlag"),
        F.col("color").alias("Color"),
        F.col("safety_stock_level").alias("SafetyStockLevel"),
        F.col("reorder_point").alias("ReorderPoint"),
        F.col("list_price").alias("ListPrice"),
        F.col("size").alias("Size"),
        F.col("weight").cast("double").alias("Weight"),
        F.col("days_to_manufacture").alias("DaysToManufacture"),
        F.col("product_line").alias("ProductLine"),
        F.col("class").alias("Class"),
        F.col("style").alias("Style"),
        "ModelName",
        "LargePhoto",
        F.col("sell_start_date").alias("StartDate"),
        F.col("sell_end_date").alias("EndDate"),
        F.col("discontinued_date").cast("string").alias("Status"),
        F.coalesce("modified_date", LOAD_COL).alias("valid_from"),
        "end_date",
        "is_current",
    )


def load_dim_product(
    target: DataFrame, enriched: DataFrame, as_of: datetime | str | None = None
) -> DataFrame:
    """Current products: new ones are added, known ones take the current values."""
    source = current(enriched).drop("end_date", "is_current")
    source = source.withColumn("ingestion_timestamp", load_stamp(as_of))
    return merge_upsert(target, source, ["ProductKey"])


def load_dim_product_history(
    target: DataFrame, enriched: DataFrame, as_of: datetime | str | None = None
) -> DataFrame:
    """Adds closed versions by product and start; ``valid_to`` is the date on
    which the version ended, the load time if that is unknown."""
    stamp = load_stamp(as_of)
    valid_to = F.coalesce("end_date", stamp)
    source = (
        closed(enriched)
        .withColumnRenamed("ProductNumber", "ProductAlternateKey")
        .withColumns(
            {
                "valid_to": valid_to,
                "closed_timestamp": stamp,
                "ingestion_timestamp": stamp,
                "year_valid_to": F.year(valid_to),
            }
        )
        .drop("end_date", "is_current")
    )
    return insert_if_absent(target, source, ["ProductKey", "valid_from"], one_per_key=True)
