"""Monthly sales per country, territory group and product line."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.money import MONEY, pct
from tidemark.operators.joins import DimSpec, star_join
from tidemark.operators.scd2 import load_stamp

# What the serving table declares. A margin beyond its three digits
# is NULL there (see ``sources.export.as_serving``).
SERVING_SCHEMA = (
    "OrderYear int, OrderMonth int, CountryRegionCode string, TerritoryGroup string, "
    "ProductLine string, TotalOrders int, TotalQuantitySold int, TotalSalesAmount decimal(19,2), "
    "TotalProductCost decimal(19,2), GrossProfit decimal(19,2), GrossMarginPct decimal(5,2), "
    "TotalTax decimal(19,2), TotalFreight decimal(19,2), TotalDiscountGiven double, "
    "last_refresh_timestamp timestamp"
)


def agg_monthly_sales(
    fact: DataFrame,
    territory: DataFrame,
    product: DataFrame,
    as_of: datetime | str | None = None,
) -> DataFrame:
    """Nine measures per month, country, territory group and product line.

    Rows without a product line and rows of a line called ``Unknown`` stay two
    groups with one label.
    """
    lines = star_join(
        fact,
        [
            DimSpec(
                territory,
                {"SalesTerritoryKey": "sales_territory_id"},
                {"CountryRegionCode": "sales_country_region_code", "TerritoryGroup": "sales_group_name"},
            ),
            DimSpec(product, {"ProductKey": "ProductKey"}, {"_line": "ProductLine"}),
        ],
    )
    sales, cost = F.col("_sales"), F.col("_cost")
    totals = lines.groupBy(
        F.year("OrderDate").alias("OrderYear"),
        F.month("OrderDate").alias("OrderMonth"),
        "CountryRegionCode",
        "TerritoryGroup",
        "_line",
    ).agg(
        F.countDistinct("SalesOrderNumber").alias("TotalOrders"),
        F.sum("OrderQuantity").alias("TotalQuantitySold"),
        F.sum("SalesAmount").alias("_sales"),
        F.sum("TotalProductCost").alias("_cost"),
        F.round(F.sum("TaxAmt"), 2).alias("TotalTax"),
        F.round(F.sum("Freight"), 2).alias("TotalFreight"),
        # Summed as decimals: the result must not depend on the order of the rows.
        F.round(F.sum(F.col("DiscountAmount").cast(MONEY)), 2).cast("double").alias("TotalDiscountGiven"),
    )
    return totals.select(
        "OrderYear",
        "OrderMonth",
        "CountryRegionCode",
        "TerritoryGroup",
        F.coalesce("_line", F.lit("Unknown")).alias("ProductLine"),
        "TotalOrders",
        "TotalQuantitySold",
        F.round(sales, 2).alias("TotalSalesAmount"),
        F.round(cost, 2).alias("TotalProductCost"),
        F.round(sales - cost, 2).alias("GrossProfit"),
        pct(sales - cost, sales).alias("GrossMarginPct"),
        "TotalTax",
        "TotalFreight",
        "TotalDiscountGiven",
        load_stamp(as_of).alias("last_refresh_timestamp"),
    )
