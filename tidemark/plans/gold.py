"""Columns of the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.fact import FACT_SCHEMA

_PRODUCT = (
    "ProductSubcategoryKey int, SizeUnitMeasureCode string, WeightUnitMeasureCode string, "
    "ProductName string, StandardCost decimal(19,4), FinishedGoodsFlag boolean, Color string, "
    "SafetyStockLevel smallint, ReorderPoint smallint, ListPrice decimal(19,4), Size string, "
    "Weight double, DaysToManufacture int, ProductLine string, Class string, Style string, "
    "ModelName string, LargePhoto string, StartDate timestamp, EndDate timestamp, Status string, "
    "valid_from timestamp"
)
_CUSTOMER = (
    "CustomerKey int, GeographyKey int, CustomerAlternateKey string, Title string, FirstName string, "
    "MiddleName string, LastName string, NameStyle boolean, BirthDate date, MaritalStatus string, "
    "Suffix string, Gender string, EmailAddress string, YearlyIncome string, TotalChildren int, "
    "NumberChildrenAtHome int, EnglishEducation string, SpanishEducation string, FrenchEducation string, "
    "EnglishOccupation string, SpanishOccupation string, FrenchOccupation string, HouseOwnerFlag string, "
    "NumberCarsOwned int, AddressLine1 string, AddressLine2 string, Phone string, "
    "DateFirstPurchase timestamp, CommuteDistance string, valid_from timestamp"
)

# Table -> columns.
GOLD_COLUMNS = {
    "dim_currency": "currency_code string, currency_name string, ingestion_timestamp timestamp",
    "dim_geography": "GeographyKey int, City string, StateProvinceCode string, StateProvinceName string, "
    "CountryRegionCode string, CountryRegionName string, PostalCode string, SalesTerritoryKey int, "
    "ingestion_timestamp timestamp",
    "dim_sales_territory": "sales_territory_id int, sales_territory_name string, "
    "sales_country_region_code string, sales_group_name string, ingestion_timestamp timestamp",
    "dim_product_category": "ProductCategoryKey int, ProductCategoryName string, IngestionTimestamp timestamp",
    "dim_product_sub_category": "ProductSubCategoryKey int, ProductSubCategoryName string, "
    "ProductCategoryKey int, IngestionTimestamp timestamp",
    "dim_promotion": "PromotionKey int, PromotionDescription string, DiscountPct float, "
    "PromotionType string, PromotionCategory string, StartDate date, EndDate date, MinQty int, MaxQty int, "
    "_ingestion_timestamp timestamp",
    "dim_sales_reason": "sales_reason_id int, sales_reason_name string, sales_reason_type string, "
    "ingestion_timestamp timestamp, sales_reason_state boolean",
    "dim_product": f"ProductKey int, ProductNumber string, {_PRODUCT}, ingestion_timestamp timestamp",
    "dim_product_history": f"ProductKey int, ProductAlternateKey string, {_PRODUCT}, valid_to timestamp, "
    "closed_timestamp timestamp, ingestion_timestamp timestamp, year_valid_to int",
    "dim_customer": f"{_CUSTOMER}, is_current boolean, ingestion_timestamp timestamp",
    "dim_customer_history": f"{_CUSTOMER}, valid_to timestamp, is_current boolean, "
    "closed_timestamp timestamp, ingestion_timestamp timestamp, year_valid_to int",
    "fact_internet_sales": f"{FACT_SCHEMA}, ingestion_timestamp timestamp",
}


def empty_gold(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], GOLD_COLUMNS[table])
