"""Calendar, simple dimensions, products and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.money import MONEY
from tidemark.functions.survey import survey_fields
from tidemark.operators.changes import table_changes
from tidemark.operators.joins import translate
from tidemark.operators.scd2 import LOAD_COL, scd2_apply
from tidemark.plans.customer import SURVEY, customer_enriched, dim_customer_load
from tidemark.plans.dimensions import (
    calendar_days,
    describe_days,
    load_dim_category,
    load_dim_currency,
    load_dim_geography,
    load_dim_promotion,
    load_dim_reason,
    load_dim_subcategory,
    load_dim_territory,
)
from tidemark.plans.product import load_dim_product, load_dim_product_history, product_enriched
from tidemark.session import stage
from tidemark.sources.lookup import EDUCATION, OCCUPATION, TRANSLATION_SCHEMA, education, lookup_table, occupation
from workload.base import FIRST_LOAD, SECOND_LOAD, nations, query, read
from workload.history import _apply_sql, _target, _TARGET_SQL, run_scd2_apply, WATCHED


def _stamp(text: str):
    return F.lit(text).cast("timestamp")


@query(
    "dim_date",
    """
WITH span AS (
    SELECT CAST(date_trunc('year', MIN(o_orderdate)) AS DATE) AS first,
           CAST(date_trunc('year', MAX(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS last
    FROM orders
),
days AS (SELECT CAST(UNNEST(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, strftime(d, '%Y-%m-%d') AS date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       'Q' || quarter(d) AS quarter_name, CAST(month(d) AS INTEGER) AS month,
       strftime(d, '%B') AS month_name, CAST(day(d) AS INTEGER) AS day,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year,
       dayofweek(d) BETWEEN 1 AND 5 AS is_weekday, dayofweek(d) IN (0, 6) AS is_weekend,
       d = last_day(d) AS is_last_day_of_month,
       CAST(CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS INTEGER) AS fiscal_year,
       CAST(CASE WHEN month(d) BETWEEN 7 AND 9 THEN 1 WHEN month(d) >= 10 THEN 2
                 WHEN month(d) <= 3 THEN 3 ELSE 4 END AS INTEGER) AS fiscal_quarter,
       CAST(CASE WHEN month(d) >= 7 THEN month(d) - 6 ELSE month(d) + 6 END AS INTEGER) AS fiscal_month
FROM days
""",
)
def run_dim_date(spark, sf_dir):
    """Calendar over the years of the orders."""
    span = read(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    years = span.select(
        F.make_date(F.year("first"), F.lit(1), F.lit(1)).alias("first"),
        F.make_date(F.year("last"), F.lit(12), F.lit(31)).alias("last"),
    )
    return describe_days(calendar_days(years, "first", "last"))


_GEO_SQL = """
    SELECT c_custkey AS GeographyKey, {city} AS City, 'N' || n_nationkey AS StateProvinceCode,
           n_name AS StateProvinceName, substr(r_name, 1, 3) AS CountryRegionCode,
           r_name AS CountryRegionName, c_name AS PostalCode, n_regionkey AS SalesTerritoryKey,
           TIMESTAMP '{stamp}' AS ingestion_timestamp
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE {test}
"""
_KNOWN_PLACE = "c_mktsegment = 'BUILDING' AND c_acctbal < 5000"


@query(
    "dim_geography",
    _GEO_SQL.format(city="'known'", stamp=FIRST_LOAD, test=_KNOWN_PLACE)
    + "UNION ALL"
    + _GEO_SQL.format(
        city="c_mktsegment", stamp=SECOND_LOAD, test=f"c_acctbal >= 0 AND NOT ({_KNOWN_PLACE})"
    ),
)
def run_dim_geography(spark, sf_dir):
    customer, land = read(spark, sf_dir, "customer"), nations(spark, sf_dir)
    code = F.substring("r_name", 1, 3)
    address = customer.select(
        F.col("c_custkey").alias("address_id"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_nationkey").alias("state_province_id"),
        F.col("c_name").alias("postal_code"),
        (F.col("c_acctbal") >= 0).alias("is_current"),
    )
    state = land.select(
        F.col("n_nationkey").alias("state_province_id"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("state_province_code"),
        F.col("n_name").alias("name"),
        code.alias("country_region_code"),
        F.col("n_regionkey").alias("territory_id"),
        F.lit(True).alias("is_current"),
    )
    country = read(spark, sf_dir, "region").select(
        code.alias("country_region_code"), F.col("r_name").alias("name"), F.lit(True).alias("is_current")
    )
    known = address.join(customer.filter(_KNOWN_PLACE), F.col("address_id") == F.col("c_custkey"), "left_semi")
    known = known.withColumns({"city": F.lit("known"), "is_current": F.lit(True)})
    first = load_dim_geography(_empty_geography(spark), known, state, country, FIRST_LOAD)
    return load_dim_geography(first, address, state, country, SECOND_LOAD)


def _empty_geography(spark) -> DataFrame:
    return spark.createDataFrame(
        [],
        "GeographyKey bigint, City string, StateProvinceCode string, StateProvinceName string, "
        "CountryRegionCode string, CountryRegionName string, PostalCode string, "
        "SalesTerritoryKey int, ingestion_timestamp timestamp",
    )


@query(
    "dim_territory",
    f"""
SELECT n_nationkey AS sales_territory_id, n_name AS sales_territory_name,
       substr(n_name, 1, 3) AS sales_country_region_code,
       r_name AS sales_group_name,
       CASE WHEN r_name = 'ASIA' THEN TIMESTAMP '{FIRST_LOAD}' ELSE TIMESTAMP '{SECOND_LOAD}' END
           AS ingestion_timestamp
FROM nation JOIN region ON n_regionkey = r_regionkey
""",
)
def run_dim_territory(spark, sf_dir):
    silver = nations(spark, sf_dir).select(
        F.col("n_nationkey").alias("territory_id"),
        F.col("n_name").alias("name"),
        F.substring("n_name", 1, 3).alias("country_region_code"),
        F.col("r_name").alias("territory_group"),
        F.lit(True).alias("is_current"),
    )
    empty = spark.createDataFrame(
        [],
        "sales_territory_id int, sales_territory_name string, sales_country_region_code string, "
        "sales_group_name string, ingestion_timestamp timestamp",
    )
    first = load_dim_territory(empty, silver.filter("territory_group = 'ASIA'"), FIRST_LOAD)
    return load_dim_territory(first, silver, SECOND_LOAD)


@query(
    "dim_category",
    f"""
SELECT r_regionkey AS ProductCategoryKey, r_name AS ProductCategoryName,
       TIMESTAMP '{SECOND_LOAD}' AS IngestionTimestamp FROM region
""",
)
def run_dim_category(spark, sf_dir):
    silver = read(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("product_category_id"), F.col("r_name").alias("name"), F.lit(True).alias("is_current")
    )
    empty = spark.createDataFrame(
        [], "ProductCategoryKey int, ProductCategoryName string, IngestionTimestamp timestamp"
    )
    return load_dim_category(empty, silver, SECOND_LOAD)


@query(
    "dim_subcategory",
    f"""
SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS ProductSubCategoryKey,
       p_brand AS ProductSubCategoryName, length(p_brand) AS ProductCategoryKey,
       TIMESTAMP '{SECOND_LOAD}' AS IngestionTimestamp
FROM part
""".replace("length(p_brand)", "CAST(length(p_brand) AS INTEGER)"),
)
def run_dim_subcategory(spark, sf_dir):
    brands = read(spark, sf_dir, "part").select("p_brand").distinct()
    silver = brands.select(
        F.substring("p_brand", 7, 10).cast("int").alias("product_subcategory_id"),
        F.col("p_brand").alias("name"),
        F.length("p_brand").alias("product_category_id"),
        F.lit(True).alias("is_current"),
    )
    empty = spark.createDataFrame(
        [],
        "ProductSubCategoryKey int, ProductSubCategoryName string, ProductCategoryKey int, "
        "IngestionTimestamp timestamp",
    )
    return load_dim_subcategory(empty, silver, SECOND_LOAD)


@query(
    "dim_promotion",
    f"""
SELECT CAST(ROUND(l_discount * 100) AS INTEGER) AS PromotionKey,
       'Discount ' || CAST(ROUND(l_discount * 100) AS INTEGER) AS PromotionDescription,
       CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS DiscountPct,
       CASE WHEN l_discount = 0 THEN 'No Discount' ELSE 'Volume Discount' END AS PromotionType,
       'Customer' AS PromotionCategory, strftime(MIN(l_shipdate), '%Y-%m-%d') AS StartDate,
       strftime(MAX(l_shipdate), '%Y-%m-%d') AS EndDate, CAST(MIN(l_quantity) AS INTEGER) AS MinQty,
       CAST(MAX(l_quantity) AS INTEGER) AS MaxQty, TIMESTAMP '{FIRST_LOAD}' AS _ingestion_timestamp
FROM lineitem GROUP BY l_discount
""",
)
def run_dim_promotion(spark, sf_dir):
    offer = F.round(F.col("l_discount") * 100).cast("int")
    silver = (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_discount")
        .agg(
            F.min("l_shipdate").alias("start_date"),
            F.max("l_shipdate").alias("end_date_offer"),
            F.min("l_quantity").cast("int").alias("min_qty"),
            F.max("l_quantity").cast("int").alias("max_qty"),
        )
        .select(
            offer.alias("special_offer_id"),
            F.concat(F.lit("Discount "), offer.cast("string")).alias("description"),
            F.col("l_discount").cast(MONEY).alias("discount_pct"),
            F.when(F.col("l_discount") == 0, "No Discount").otherwise("Volume Discount").alias("type"),
            F.lit("Customer").alias("category"),
            "start_date",
            "end_date_offer",
            "min_qty",
            "max_qty",
            F.lit(True).alias("is_current"),
            _stamp(FIRST_LOAD).alias(LOAD_COL),
        )
    )
    empty = spark.createDataFrame(
        [],
        "PromotionKey int, PromotionDescription string, DiscountPct float, PromotionType string, "
        "PromotionCategory string, StartDate date, EndDate date, MinQty int, MaxQty int, "
        "_ingestion_timestamp timestamp",
    )
    return load_dim_promotion(empty, silver)


@query(
    "dim_currency",
    f"""
SELECT substr(r_name, 1, 3) AS currency_code, r_name AS currency_name,
       TIMESTAMP '{SECOND_LOAD}' AS ingestion_timestamp FROM region
""",
)
def run_dim_currency(spark, sf_dir):
    silver = read(spark, sf_dir, "region").select(
        F.substring("r_name", 1, 3).alias("currency_code"), F.col("r_name").alias("name")
    )
    empty = spark.createDataFrame(
        [], "currency_code string, currency_name string, ingestion_timestamp timestamp"
    )
    return load_dim_currency(empty, silver, SECOND_LOAD)


_REASON_SQL = "SELECT user_id, event_type, props, bool_or(is_current) AS open FROM ({}) GROUP BY ALL"


@query(
    "dim_reason_state",
    f"""
SELECT n.user_id AS sales_reason_id, n.event_type AS sales_reason_name, n.props AS sales_reason_type,
       CASE WHEN n.open = o.open THEN TIMESTAMP '{FIRST_LOAD}' ELSE TIMESTAMP '{SECOND_LOAD}' END
           AS ingestion_timestamp,
       n.open AS sales_reason_state
FROM ({_REASON_SQL.format(_apply_sql("user_id", WATCHED))}) n
LEFT JOIN ({_REASON_SQL.format(_TARGET_SQL)}) o
  ON n.user_id = o.user_id AND n.event_type IS NOT DISTINCT FROM o.event_type AND n.props IS NOT DISTINCT FROM o.props
""",
)
def run_dim_reason_state(spark, sf_dir):
    def silver(rows):
        return rows.select(
            F.col("user_id").alias("sales_reason_id"),
            F.col("event_type").alias("name"),
            F.col("props").alias("reason_type"),
            "is_current",
        )

    empty = spark.createDataFrame(
        [],
        "sales_reason_id bigint, sales_reason_name string, sales_reason_type string, "
        "ingestion_timestamp timestamp, sales_reason_state boolean",
    )
    first = load_dim_reason(empty, silver(_target(spark, sf_dir)), FIRST_LOAD)
    return load_dim_reason(first, silver(run_scd2_apply(spark, sf_dir)), SECOND_LOAD)


def _product_versions(spark, sf_dir) -> DataFrame:
    """Parts as products: every part since 2000, the larger ones also before, at
    half the cost."""
    part = read(spark, sf_dir, "part")
    cost = F.col("p_retailprice").cast(MONEY)

    def version(rows, since, until, is_current, at_cost):
        return rows.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("product_number"),
            F.lit(True).alias("finished_goods_flag"),
            F.lit(None).cast("string").alias("color"),
            F.lit(None).cast("smallint").alias("safety_stock_level"),
            F.lit(None).cast("smallint").alias("reorder_point"),
            at_cost.alias("standard_cost"),
            cost.alias("list_price"),
            F.col("p_size").cast("string").alias("size"),
            F.lit(None).cast("string").alias("size_unit_measure_code"),
            F.lit(None).cast("string").alias("weight_unit_measure_code"),
            (F.col("p_size") * 2).cast(MONEY).alias("weight"),
            F.col("p_size").alias("days_to_manufacture"),
            F.col("p_brand").alias("product_line"),
            F.lit(None).cast("string").alias("class"),
            F.lit(None).cast("string").alias("style"),
            F.substring("p_brand", 7, 10).cast("int").alias("product_subcategory_id"),
            F.col("p_size").cast("bigint").alias("product_model_id"),
            _stamp(since).alias("sell_start_date"),
            F.lit(None).cast("timestamp").alias("sell_end_date"),
            F.lit(None).cast("timestamp").alias("discontinued_date"),
            _stamp(since).alias("modified_date"),
            _stamp(FIRST_LOAD).alias(LOAD_COL),
            F.lit(is_current).alias("is_current"),
            _stamp(until).alias("end_date"),
        )

    half = F.round(cost / 2, 4).cast(MONEY)
    now = version(part, "2000-01-01", "9999-12-31", True, cost)
    before = version(part.filter("p_size > 25"), "1995-01-01", "2000-01-01", False, half)
    return now.unionByName(before)


def _products(spark, sf_dir) -> DataFrame:
    supplier = read(spark, sf_dir, "supplier")
    model = supplier.select(
        F.col("s_suppkey").alias("product_model_id"), F.col("s_name").alias("name"), (F.col("s_acctbal") >= 0).alias("is_current")
    )
    photo = supplier.select(
        F.col("s_suppkey").alias("product_photo_id"),
        F.concat("s_name", F.lit(".gif")).alias("large_photo_file_name"),
        F.lit(True).alias("is_current"),
    )
    link = read(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("product_photo_id"), F.lit(True).alias("is_current")
    )
    return product_enriched(_product_versions(spark, sf_dir), model, link, photo)


_PRODUCT_SCHEMA = (
    "ProductKey bigint, {number} string, ProductSubcategoryKey int, SizeUnitMeasureCode string, "
    "WeightUnitMeasureCode string, ProductName string, StandardCost decimal(19,4), "
    "FinishedGoodsFlag boolean, Color string, SafetyStockLevel smallint, ReorderPoint smallint, "
    "ListPrice decimal(19,4), Size string, Weight double, DaysToManufacture int, ProductLine string, "
    "Class string, Style string, ModelName string, LargePhoto string, StartDate timestamp, "
    "EndDate timestamp, Status string, valid_from timestamp{more}, ingestion_timestamp timestamp"
)
_PRODUCT_SQL = """
SELECT p_partkey AS ProductKey, p_type AS {number},
       CAST(substr(p_brand, 7) AS INTEGER) AS ProductSubcategoryKey,
       CAST(NULL AS VARCHAR) AS SizeUnitMeasureCode, CAST(NULL AS VARCHAR) AS WeightUnitMeasureCode,
       p_name AS ProductName, {cost} AS StandardCost, true AS FinishedGoodsFlag,
       CAST(NULL AS VARCHAR) AS Color, CAST(NULL AS INTEGER) AS SafetyStockLevel,
       CAST(NULL AS INTEGER) AS ReorderPoint, p_retailprice AS ListPrice,
       CAST(p_size AS VARCHAR) AS Size, CAST(p_size * 2 AS DOUBLE) AS Weight,
       p_size AS DaysToManufacture, p_brand AS ProductLine, CAST(NULL AS VARCHAR) AS Class,
       CAST(NULL AS VARCHAR) AS Style, m.s_name AS ModelName, ph.s_name || '.gif' AS LargePhoto,
       TIMESTAMP '{since}' AS StartDate, CAST(NULL AS TIMESTAMP) AS EndDate,
       CAST(NULL AS VARCHAR) AS Status, TIMESTAMP '{since}' AS valid_from{more},
       TIMESTAMP '{stamp}' AS ingestion_timestamp
FROM part
LEFT JOIN supplier m ON p_size = m.s_suppkey AND m.s_acctbal >= 0
LEFT JOIN (SELECT l_partkey, MAX(l_suppkey) AS photo FROM lineitem GROUP BY l_partkey)
    ON p_partkey = l_partkey
LEFT JOIN supplier ph ON photo = ph.s_suppkey
WHERE {test}
"""


@query(
    "dim_product_current",
    _PRODUCT_SQL.format(
        number="ProductNumber", cost="p_retailprice", since="2000-01-01", more="", stamp=SECOND_LOAD, test="true"
    ),
    optional="SafetyStockLevel ReorderPoint",
)
def run_dim_product_current(spark, sf_dir):
    empty = spark.createDataFrame([], _PRODUCT_SCHEMA.format(number="ProductNumber", more=""))
    products = stage(_products(spark, sf_dir), "products")
    # The first load holds the smaller parts at another price and name.
    before = products.filter("Size <= 25").withColumns(
        {"ListPrice": F.lit(1).cast(products.schema["ListPrice"].dataType), "ProductName": F.lit("old name")}
    )
    first = load_dim_product(empty, before, FIRST_LOAD)
    return load_dim_product(first, products, SECOND_LOAD)


@query(
    "dim_product_history",
    _PRODUCT_SQL.format(
        number="ProductAlternateKey",
        cost="CAST(CAST((CAST(ROUND(p_retailprice * 10000) AS BIGINT) + 1) // 2 AS DECIMAL(19,0))"
        " * CAST('0.0001' AS DECIMAL(5,4)) AS DOUBLE)",
        since="1995-01-01",
        more=", TIMESTAMP '2000-01-01' AS valid_to, "
        f"TIMESTAMP '{SECOND_LOAD}' AS closed_timestamp, 2000 AS year_valid_to",
        stamp=SECOND_LOAD,
        test="p_size > 25",
    ),
    optional="SafetyStockLevel ReorderPoint",
)
def run_dim_product_history(spark, sf_dir):
    more = ", valid_to timestamp, closed_timestamp timestamp, year_valid_to int"
    empty = spark.createDataFrame([], _PRODUCT_SCHEMA.format(number="ProductAlternateKey", more=more))
    return load_dim_product_history(empty, _products(spark, sf_dir), SECOND_LOAD)


# ---------------------------------------------------------------- customers

# What the survey of a customer says, as Spark SQL and DuckDB SQL alike.
_ANSWERS = {
    "BirthDate": "CASE WHEN c_acctbal > 5000 THEN '1966-04-08Z' ELSE '1971-10-06' END",
    "MaritalStatus": "CASE WHEN c_nationkey > 12 THEN 'M' ELSE 'S' END",
    "Gender": "CASE WHEN c_acctbal > 0 THEN 'F' ELSE 'M' END",
    "YearlyIncome": "CASE WHEN c_acctbal > 2500 THEN '75001-100000' ELSE '0-25000' END",
    "TotalChildren": "CAST(c_nationkey AS {text})",
    "NumberChildrenAtHome": "CASE WHEN c_nationkey > 20 THEN 'many' ELSE '1' END",
    "Education": "CASE c_mktsegment WHEN 'BUILDING' THEN 'Bachelors' WHEN 'MACHINERY' THEN 'High School' "
    "WHEN 'AUTOMOBILE' THEN 'Graduate Degree' ELSE 'Night School' END",
    "Occupation": "CASE WHEN c_nationkey < 5 THEN 'Clerical' WHEN c_nationkey < 10 THEN 'Management' "
    "WHEN c_nationkey < 15 THEN 'Skilled Manual' ELSE 'Retired' END",
    "HomeOwnerFlag": "'1'",
    "NumberCarsOwned": "CASE WHEN c_nationkey = 3 THEN '' ELSE '2' END",
}
_HAS_SURVEY = "c_mktsegment <> 'FURNITURE'"


def _with_survey(customer: DataFrame) -> DataFrame:
    """The answers as XML: with a namespace, a missing node (CommuteDistance)
    and, for one segment, text that is no XML."""
    nodes = [
        F.concat(F.lit(f"<{node}>"), F.expr(value.format(text="string")), F.lit(f"</{node}>"))
        for node, value in _ANSWERS.items()
    ]
    xml = F.concat(
        F.lit('<IndividualSurvey xmlns="http://example.com/survey">'), *nodes, F.lit("</IndividualSurvey>")
    )
    return customer.withColumn("demographics", F.when(F.expr(_HAS_SURVEY), xml).otherwise("n/a"))


def _answer(node: str) -> str:
    return f"CASE WHEN {_HAS_SURVEY} THEN {_ANSWERS[node].format(text='VARCHAR')} END"


_SURVEY_SQL = f"""
       replace({_answer("BirthDate")}, 'Z', '') AS BirthDate,
       {_answer("MaritalStatus")} AS MaritalStatus, {_answer("Gender")} AS Gender,
       {_answer("YearlyIncome")} AS YearlyIncome,
       TRY_CAST({_answer("TotalChildren")} AS INTEGER) AS TotalChildren,
       TRY_CAST({_answer("NumberChildrenAtHome")} AS INTEGER) AS NumberChildrenAtHome,
       {_answer("Education")} AS EnglishEducation, {_answer("Occupation")} AS EnglishOccupation,
       {_answer("HomeOwnerFlag")} AS HouseOwnerFlag,
       TRY_CAST({_answer("NumberCarsOwned")} AS INTEGER) AS NumberCarsOwned,
       CAST(NULL AS VARCHAR) AS CommuteDistance
"""


# Whole numbers that a survey may leave open.
_COUNTS = "TotalChildren NumberChildrenAtHome NumberCarsOwned"


@query("survey_xml", f"SELECT c_custkey, {_SURVEY_SQL} FROM customer", optional=_COUNTS)
def run_survey_xml(spark, sf_dir):
    found = survey_fields(_with_survey(read(spark, sf_dir, "customer")), "demographics", SURVEY)
    return found.select("c_custkey", *SURVEY)


def _lookup_sql(name: str, rows) -> str:
    values = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)
    return f"(VALUES {values}) AS {name}(EnglishValue, SpanishValue, FrenchValue)"


# One translation per market segment; FURNITURE has none.
_SEGMENTS = [
    ("AUTOMOBILE", "automóvil", "automobile"),
    ("BUILDING", "construcción", "bâtiment"),
    ("HOUSEHOLD", "hogar", "ménage"),
    ("MACHINERY", "maquinaria", "machines"),
]


@query(
    "translate_segment",
    f"""
SELECT c_custkey, c_mktsegment, COALESCE(SpanishValue, c_mktsegment) AS SpanishSegment,
       COALESCE(FrenchValue, c_mktsegment) AS FrenchSegment
FROM customer LEFT JOIN {_lookup_sql("seg", _SEGMENTS)} ON c_mktsegment = EnglishValue
""",
)
def run_translate_segment(spark, sf_dir):
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    into = {"SpanishSegment": "SpanishValue", "FrenchSegment": "FrenchValue"}
    lookup = lookup_table(spark, _SEGMENTS, TRANSLATION_SCHEMA)
    return translate(customer, "c_mktsegment", lookup, "EnglishValue", into)


_CUSTOMER_STATE = (
    "customer_id bigint, person_id bigint, territory_id int, account_number string, "
    "modified_date timestamp, _ingestion_timestamp timestamp, is_current boolean, end_date timestamp"
)
_DIM_CUSTOMER = (
    "CustomerKey bigint, GeographyKey int, CustomerAlternateKey string, Title string, FirstName string, "
    "MiddleName string, LastName string, NameStyle boolean, BirthDate date, MaritalStatus string, "
    "Suffix string, Gender string, EmailAddress string, YearlyIncome string, TotalChildren int, "
    "NumberChildrenAtHome int, EnglishEducation string, SpanishEducation string, FrenchEducation string, "
    "EnglishOccupation string, SpanishOccupation string, FrenchOccupation string, HouseOwnerFlag string, "
    "NumberCarsOwned int, AddressLine1 string, AddressLine2 string, Phone string, "
    "DateFirstPurchase timestamp, CommuteDistance string, valid_from timestamp, "
)
_DIM_CURRENT = _DIM_CUSTOMER + "is_current boolean, ingestion_timestamp timestamp"
_DIM_HISTORY = _DIM_CUSTOMER + (
    "valid_to timestamp, is_current boolean, closed_timestamp timestamp, "
    "ingestion_timestamp timestamp, year_valid_to int"
)


def _dim_customer(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Two loads. First every customer but those of MACHINERY; then BUILDING
    moves to another territory and account, and MACHINERY is new."""
    customer = _with_survey(read(spark, sf_dir, "customer"))

    def batch(rows, since, territory, account):
        return rows.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_custkey").alias("person_id"),
            territory.alias("territory_id"),
            account.alias("account_number"),
            _stamp(since).alias("modified_date"),
        )

    nation, name = F.col("c_nationkey"), F.col("c_name")
    moved = F.col("c_mktsegment") == "BUILDING"
    keys, watched = ["customer_id"], ["territory_id", "person_id", "account_number"]
    v1 = scd2_apply(
        spark.createDataFrame([], _CUSTOMER_STATE),
        batch(customer.filter("c_mktsegment <> 'MACHINERY'"), "2020-01-01", nation, name),
        keys, watched, "modified_date", as_of=FIRST_LOAD,
    )
    v1 = stage(v1, "customer-v1")
    v2 = scd2_apply(
        v1,
        batch(
            customer,
            "2023-06-01",
            nation + F.when(moved, 1).otherwise(0),
            F.concat(F.when(moved, "NEW-").otherwise(""), name),
        ),
        keys, watched, "modified_date", as_of=SECOND_LOAD,
    )
    # Staged: the feed compares two versions as stored.
    versions = {1: v1, 2: stage(v2, "customer-v2")}

    person = customer.select(
        F.col("c_custkey").alias("business_entity_id"),
        F.lit(None).cast("string").alias("title"),
        F.col("c_mktsegment").alias("first_name"),
        F.lit(None).cast("string").alias("middle_name"),
        name.alias("last_name"),
        F.lit(False).alias("name_style"),
        F.lit(None).cast("string").alias("suffix"),
        "demographics",
        F.lit(True).alias("is_current"),
    )
    order_id = F.col("o_orderkey")
    email = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("business_entity_id"),
        order_id.alias("email_address_id"),
        F.concat(F.lit("o"), order_id.cast("string"), F.lit("@example.com")).alias("email_address"),
        F.lit(True).alias("is_current"),
    )
    phone = read(spark, sf_dir, "events").select(
        F.col("user_id").alias("business_entity_id"),
        F.col("event_id").alias("phone_number_type_id"),
        F.col("props").alias("phone_number"),
        F.lit(True).alias("is_current"),
    )
    entity_address = customer.select(
        F.col("c_custkey").alias("business_entity_id"),
        F.lit(1).alias("address_type_id"),
        nation.alias("address_id"),
        F.lit(True).alias("is_current"),
    )
    address = read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("address_id"),
        F.col("n_name").alias("address_line1"),
        F.lit(None).cast("string").alias("address_line2"),
        F.lit(True).alias("is_current"),
    )

    def enriched(version):
        feed = table_changes(versions, version, ["customer_id", "modified_date"], end=version)
        return customer_enriched(
            feed, person, email, phone, entity_address, address, education(spark), occupation(spark)
        )

    dim, history = dim_customer_load(
        spark.createDataFrame([], _DIM_CURRENT),
        spark.createDataFrame([], _DIM_HISTORY),
        stage(enriched(1), "customers-1"),
        FIRST_LOAD,
    )
    return dim_customer_load(dim, history, stage(enriched(2), "customers-2"), SECOND_LOAD)


_CUSTOMER_SQL = f"""
SELECT c_custkey AS CustomerKey, c_nationkey AS GeographyKey, c_name AS CustomerAlternateKey,
       CAST(NULL AS VARCHAR) AS Title, c_mktsegment AS FirstName, CAST(NULL AS VARCHAR) AS MiddleName,
       c_name AS LastName, false AS NameStyle, CAST(NULL AS VARCHAR) AS Suffix,
       'o' || mail || '@example.com' AS EmailAddress, COALESCE(edu.SpanishValue, EnglishEducation)
           AS SpanishEducation,
       COALESCE(edu.FrenchValue, EnglishEducation) AS FrenchEducation,
       COALESCE(occ.SpanishValue, EnglishOccupation) AS SpanishOccupation,
       COALESCE(occ.FrenchValue, EnglishOccupation) AS FrenchOccupation,
       n_name AS AddressLine1, CAST(NULL AS VARCHAR) AS AddressLine2, phone AS Phone,
       BirthDate, MaritalStatus, Gender, YearlyIncome, TotalChildren, NumberChildrenAtHome,
       EnglishEducation, EnglishOccupation, HouseOwnerFlag, NumberCarsOwned, CommuteDistance,
       {{more}}
FROM (SELECT *, {_SURVEY_SQL} FROM customer)
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, MAX(o_orderkey) AS mail FROM orders GROUP BY 1) ON c_custkey = o_custkey
LEFT JOIN (SELECT user_id, arg_max(props, event_id) AS phone FROM events GROUP BY 1) ON c_custkey = user_id
LEFT JOIN {_lookup_sql("edu", EDUCATION)} ON EnglishEducation = edu.EnglishValue
LEFT JOIN {_lookup_sql("occ", OCCUPATION)} ON EnglishOccupation = occ.EnglishValue
"""
_SINCE = (
    "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN TIMESTAMP '2023-06-01' "
    "ELSE TIMESTAMP '2020-01-01' END"
)


@query(
    "dim_customer_current",
    _CUSTOMER_SQL.format(
        more=f"{_SINCE} AS DateFirstPurchase, {_SINCE} AS valid_from, true AS is_current, "
        "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') "
        f"THEN TIMESTAMP '{SECOND_LOAD}' ELSE TIMESTAMP '{FIRST_LOAD}' END AS ingestion_timestamp"
    ),
    optional=_COUNTS,
)
def run_dim_customer_current(spark, sf_dir):
    return _dim_customer(spark, sf_dir)[0]


@query(
    "dim_customer_history",
    _CUSTOMER_SQL.format(
        more="TIMESTAMP '2020-01-01' AS DateFirstPurchase, TIMESTAMP '2020-01-01' AS valid_from, "
        "TIMESTAMP '2023-06-01' AS valid_to, false AS is_current, "
        f"TIMESTAMP '{SECOND_LOAD}' AS closed_timestamp, TIMESTAMP '{SECOND_LOAD}' AS ingestion_timestamp, "
        "2023 AS year_valid_to"
    )
    + " WHERE c_mktsegment = 'BUILDING'",
    optional=_COUNTS,
)
def run_dim_customer_history(spark, sf_dir):
    return _dim_customer(spark, sf_dir)[1]
