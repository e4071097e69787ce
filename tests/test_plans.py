"""Conforming, calendar, survey, look-ups, files and the gold pipelines."""

from __future__ import annotations

import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import rows, shuffle_files
from tidemark.functions.calendar import fiscal_parts
from tidemark.functions.money import pct
from tidemark.functions.survey import survey_fields
from tidemark.functions.text import norm_xml, strip_delims
from tidemark.operators.checks import count_tables, probe_text
from tidemark.operators.conform import ColSpec, conform, with_load_ts
from tidemark.operators.joins import DimSpec, LookUps, left_current, star_join, translate
from tidemark.operators.layout import cluster, write_partitioned
from tidemark.operators.malformed import malformed, well_formed
from tidemark.plans.customer import SURVEY, customer_enriched, dim_customer_load
from tidemark.plans.dimensions import dim_date, load_dim_reason
from tidemark.plans.fact import fact_load, fact_sales
from tidemark.plans.lakehouse import Lakehouse
from tidemark.plans.monthly import SERVING_SCHEMA, agg_monthly_sales
from tidemark.plans.raw import RAW_COLUMNS, read_raw
from tidemark.plans.silver import HISTORIES, INSERT_ONLY, empty_silver, load_silver, silver_schema
from tidemark.session import scratch, shared_dir, stage, work_path
from tidemark.sources.delimited import CONTROL_A, read_delimited, write_delimited
from tidemark.sources.export import as_serving, export_parquet, publish, read_export, read_published
from tidemark.sources.jdbc import read_jdbc_table
from tidemark.sources.lookup import education, occupation
from tidemark.sources.snapshots import read_snapshot


def test_conform(spark):
    df = spark.createDataFrame([("1", "-1.23456", "x"), (None, "2", "y"), ("300", "abc", None)], "`Id` string, `Amt` string, `Group` string")
    spec = [ColSpec("Id", "id", "int"), ColSpec("Amt", "amt", "", abs=True), ColSpec("Group", "grp", "string"), ColSpec("Id", "tiny", "tinyint")]
    got = conform(df, spec, ["id"])
    assert rows(got) == [(1, Decimal("1.2346"), "x", 1), (300, None, None, None)]
    assert with_load_ts(got, as_of="2024-01-01").first()[-1] == datetime(2024, 1, 1)


def test_text(spark):
    df = spark.createDataFrame([("<a> <b/></a> ",), ("<a><b/></a>",), (None,)], "x string")
    assert rows(df.select(norm_xml(F.col("x")))) == [("",), ("<a><b/></a>",), ("<a><b/></a>",)]
    dirty = spark.createDataFrame([("a\nb\x01c\rd",)], "x string")
    assert strip_delims(dirty, ["x"]).first().x == "abcd"


def test_calendar(spark):
    days = {r.date: r for r in dim_date(spark).collect()}
    assert len(days) == 7670
    assert days[date(2024, 2, 29)].is_last_day_of_month and days[date(2024, 2, 29)].date_sk == 20240229
    june, july = days[date(2024, 6, 30)], days[date(2024, 7, 1)]
    assert (june.fiscal_year, june.fiscal_quarter, june.fiscal_month) == (2024, 4, 12)
    assert (july.fiscal_year, july.fiscal_quarter, july.fiscal_month) == (2025, 1, 1)
    monday = days[date(2024, 12, 30)]
    assert (monday.week_of_year, monday.day_of_week, monday.is_weekday, monday.is_weekend) == (1, 2, True, False)
    assert (monday.month_name, monday.day_name, monday.quarter_name) == ("December", "Monday", "Q4")
    plain = spark.range(1).select(*[p.alias(n) for n, p in fiscal_parts(F.lit(date(2024, 5, 1)), 1).items()])
    assert rows(plain) == [(2024, 2, 5)]


def test_ratio_of_nothing_is_null(spark):
    df = spark.createDataFrame([(Decimal("1"), Decimal("0")), (Decimal("1"), Decimal("3"))], "a decimal(19,4), b decimal(19,4)")
    assert rows(df.select(pct(F.col("a"), F.col("b")))) == [(Decimal("33.33"),), (None,)]


def test_survey(spark):
    ns = '<IndividualSurvey xmlns="http://x"><BirthDate>1966-04-08Z</BirthDate><TotalChildren>2</TotalChildren></IndividualSurvey>'
    plain = " <IndividualSurvey><BirthDate>bad</BirthDate><Gender>M</Gender><TotalChildren>x</TotalChildren></IndividualSurvey>"
    df = spark.createDataFrame([(1, ns), (2, plain), (3, "abc"), (4, None), (5, ns[:-9])], "i int, x string")
    got = survey_fields(df, "x", SURVEY, bad_col="bad").select("i", "BirthDate", "Gender", "TotalChildren", "bad")
    none = (None, None, None)
    assert rows(got) == [
        (1, date(1966, 4, 8), None, 2, False), (2, None, "M", None, False),
        (3, *none, False), (4, *none, False), (5, *none, True),
    ]
    assert survey_fields(df, "x", {"Gender": SURVEY["Gender"]}, blank_as_null=False).first().Gender == ""


def test_star_join_and_translate(spark):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, fk int")
    dim = spark.createDataFrame([(10, "ten", True), (10, "old", False), (99, "gone", False)], "d int, name string, is_current boolean")
    assert rows(left_current(fact, dim, {"fk": "d"}, {"n": "name"})) == [(1, 10, "ten"), (2, None, None), (3, 99, None)]
    needed = DimSpec(dim, {"fk": "d"}, {"n": "name"}, required=True, current_only=True)
    assert rows(star_join(fact, [needed])) == [(1, 10, "ten")]
    words = spark.createDataFrame([("Bachelors",), ("Unknown school",), (None,)], "e string")
    got = translate(words, "e", education(spark), "EnglishValue", {"es": "SpanishValue"})
    assert rows(got) == [("Bachelors", "Licenciatura"), ("Unknown school", "Unknown school"), (None, None)]
    assert education(spark).count() == occupation(spark).count() == 5


def test_look_ups_are_counted_in_passing(spark):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 99), (4, 10)], "id int, fk int")
    dim = spark.createDataFrame([(10, "ten"), (11, "eleven")], "d int, name string")
    report = LookUps()
    specs = [DimSpec(dim, {"fk": "d"}, {"n": "name"}), DimSpec(dim, {"n": "name"}, required=True)]
    assert rows(star_join(fact, specs, report)) == rows(star_join(fact, specs)) == [(1, 10, "ten"), (4, 10, "ten")]
    assert report.check() == {
        "fk": {"unmatched": 2, "dropped": 0, "multiplied": 0}, "n": {"unmatched": 2, "dropped": 2, "multiplied": 0},
    }
    report = LookUps()
    star_join(fact, [DimSpec(dim.union(dim), {"fk": "d"})], report).collect()
    with pytest.raises(ValueError, match="more than once.*'fk': 2"):
        report.check()


def test_lines_that_do_not_fit(spark):
    path = work_path(spark, "text")
    lines = ["1,a,2", "1,a", "1,a,2,3", "null,b,5", "x,b,5", "7,c,soon", '8,"p, q",3', "9,null,null"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    raw = read_delimited(spark, path, "a string, b string, c string", lines=True)
    spec = [ColSpec("a", "id", "int"), ColSpec("b", "name", "string"), ColSpec("c", "n", "int")]
    assert rows(malformed(raw, spec, ["id"]).select("reason", "kept", "content")) == [
        ("n is no int", True, '{"a":"7","b":"c","c":"soon"}'), ("no id", False, '{"a":"x","b":"b","c":"5"}'),
        ("no id", False, '{"b":"b","c":"5"}'), ("number of fields", False, "1,a"), ("number of fields", False, "1,a,2,3"),
    ]
    assert rows(conform(well_formed(raw), spec, ["id"])) == [(1, "a", 2), (7, "c", None), (8, "p, q", 3), (9, None, None)]


def test_published_exports(spark):
    path, schema = work_path(spark, "export"), "a int, b decimal(5,2)"
    first = spark.createDataFrame([(1, Decimal("999.99")), (2, Decimal("1000.00")), (3, None)], "a int, b decimal(9,2)")
    told = publish(first, path, schema)
    assert (told.version, told.rows, told.misfits) == (1, 3, {"b": 1})
    reader = read_published(spark, path)
    second = publish(first.filter("a = 1"), path, schema)
    # Who reads the first export goes on reading it.
    assert rows(reader) == [(1, Decimal("999.99")), (2, None), (3, None)]
    assert rows(read_published(spark, path)) == [(1, Decimal("999.99"))] and second.misfits == {}
    assert second.location != told.location and rows(read_export(spark, second.location, schema)) == [(1, Decimal("999.99"))]


def test_delimited_text(spark):
    schema = "a int, b string, c string"
    path = work_path(spark, "text")
    spark.createDataFrame([("null,null,x",), ('7,"p, q",y',)], "value string").coalesce(1).write.text(path)
    assert rows(read_delimited(spark, path, schema)) == [(7, "p, q", "y"), (None, None, "x")]
    df = spark.createDataFrame([(1, '<a x="1,2">t</a>', None)], schema)
    path = work_path(spark, "text")
    write_delimited(df, path, CONTROL_A)
    assert rows(read_delimited(spark, path, schema, CONTROL_A)) == [(1, '<a x="1,2">t</a>', None)]


def test_jdbc_needs_bounds_for_several_partitions(spark):
    with pytest.raises(ValueError):
        read_jdbc_table(spark, "jdbc:none", "t", num_partitions=4)


def test_every_raw_table_has_a_cleaned_one(spark):
    assert set(RAW_COLUMNS) == set(HISTORIES) | set(INSERT_ONLY) and len(RAW_COLUMNS) == 25
    for table in RAW_COLUMNS:
        schema = T.StructType.fromDDL(silver_schema(table))
        for h in [HISTORIES[table]] if table in HISTORIES else []:
            assert {*h.keys, *h.monitored, *h.latest_cols, *h.cluster_by} <= set(schema.names)
        for key in INSERT_ONLY.get(table, ()):
            assert key in schema.names
    header = T.StructType.fromDDL(silver_schema("sales_salesorderheader"))
    assert header["order_date"].dataType == T.DateType() and header["sub_total"].dataType == T.DecimalType(19, 4)
    assert "thumbnail_photo_file_name" in silver_schema("production_productphoto")
    assert "thumb_nail" not in silver_schema("production_productphoto")
    assert "sales_ytd decimal(19,4)" in silver_schema("sales_salesterritory")
    assert "end_date_offer timestamp" in silver_schema("sales_specialoffer")


@pytest.mark.parametrize("table", ["sales_salesreason", "sales_currency", "production_productmodel", "production_productproductphoto"])
def test_loading_raw_text(spark, table):
    """Each form of load: watched, insert-only, latest value, nothing watched."""
    lines = {
        "sales_salesreason": ["1,Price,Other,2020-01-01 00:00:00", "null,x,y,2020-01-01 00:00:00", "1,null,Other,2020-02-01 00:00:00"],
        "sales_currency": ["EUR,Euro,2020-01-01 00:00:00", "null,None,2020-01-01 00:00:00"],
        "production_productmodel": ["1\x01M\x01<a> <b/></a>\x01first\x01g\x012020-01-01 00:00:00", "1\x01M\x01<a><b/></a>\x01second\x01g\x012020-02-01 00:00:00"],
        "production_productproductphoto": ["1,2,g,2020-01-01 00:00:00", "1,3,g,2020-01-01 00:00:00"],
    }[table]
    path = work_path(spark, "raw")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    raw = read_raw(spark, table, path)
    once = load_silver(empty_silver(spark, table), raw, table, "2024-01-01")
    assert once.schema.names == T.StructType.fromDDL(silver_schema(table)).names
    want = {"sales_salesreason": 2, "sales_currency": 1, "production_productmodel": 2, "production_productproductphoto": 2}
    assert once.count() == want[table]
    if table == "production_productmodel":
        assert {r.instructions for r in once.collect()} == {"second"}
    assert rows(load_silver(once, raw, table, "2024-02-01")) == rows(once)


def test_same_day_headers_keep_the_last(spark):
    table = "sales_salesorderheader"
    names = [c.split(" ")[0] for c in RAW_COLUMNS[table].split(", ")]

    def raw(*versions):
        cells = [{"SalesOrderID": "1", "SubTotal": s, "Status": "5", "TotalDue": s, "ModifiedDate": m} for s, m in versions]
        return spark.createDataFrame([tuple(c.get(n) for n in names) for c in cells], ", ".join(f"{n} string" for n in names))

    df = load_silver(empty_silver(spark, table), raw(("9", "2020-01-01 10:00:00"), ("-5", "2020-01-01 11:00:00")), table)
    assert rows(df.select("sub_total", "is_current")) == [(Decimal("5.0000"), True)]


def _headers(spark, *versions):
    names = [c.split(" ")[0] for c in RAW_COLUMNS["sales_salesorderheader"].split(", ")]
    cells = [{"SalesOrderID": k, "SubTotal": s, "Status": "5", "TotalDue": s, "ModifiedDate": m} for k, s, m in versions]
    return spark.createDataFrame([tuple(c.get(n) for n in names) for c in cells], ", ".join(f"{n} string" for n in names))


def test_every_version_of_a_day(spark):
    table, day = "sales_salesorderheader", "2020-01-01 "
    first = [("1", "9", day + "10:00:00"), ("1", "5", day + "11:00:00"), ("2", "1", day + "10:00:00")]
    second = [("1", "9", day + "12:00:00"), ("1", "9", day + "13:00:00"), ("2", "1", day + "10:00:00"), ("2", "2", day + "12:30:00")]

    def load(target, *versions):
        return load_silver(target, _headers(spark, *versions), table, "2024-01-01", every_version=True).localCheckpoint()

    def lines(df):
        return [(r[0], int(r[1]), str(r[2]), r[3], str(r[4])) for r in rows(df.select("sales_order_id", "sub_total", "modified_date", "is_current", "end_date"))]

    end, d = "9999-12-31 00:00:00", "2020-01-01"
    once = load(empty_silver(spark, table), *first)
    assert lines(once) == sorted([(1, 9, d, False, d + " 11:00:00"), (1, 5, d, True, end), (2, 1, d, True, end)], key=repr)
    assert rows(load(once, *first)) == rows(once)
    twice = load(once, *second)
    want = [(1, 9, d, False, d + " 11:00:00"), (1, 5, d, False, d + " 12:00:00"), (1, 9, d, True, end), (2, 1, d, False, d + " 12:30:00"), (2, 2, d, True, end)]
    assert sorted(lines(twice), key=repr) == sorted(want, key=repr)
    for again in (first, second, first + second):
        assert rows(load(twice, *again)) == rows(twice)
    assert twice.schema.names == T.StructType.fromDDL(silver_schema(table)).names


def test_every_version_of_a_day_through_the_lakehouse(spark):
    table, raw = "sales_salesorderheader", work_path(spark, "raw")
    lake = Lakehouse(spark, work_path(spark, "lake"), files=2, as_of="2024-01-01")
    batch = [("1", "9", "2020-01-01 10:00:00"), ("1", "5", "2020-01-01 11:00:00"), ("3", "5", None), ("3", "6", None)]
    write_delimited(_headers(spark, *batch), f"{raw}/{table}")
    lake.load_silver(raw, [table])
    assert lake.silver(table).count() == 2 and read_snapshot(spark, lake.path(f"rejects/{table}")).count() == 2
    assert rows(lake._changes(table)[0].select("sub_total", "_change_type")) == [(Decimal("5.0000"), "insert"), (Decimal("9.0000"), "insert")]
    raw = work_path(spark, "raw")
    write_delimited(_headers(spark, ("1", "7", "2020-01-01 11:00:00")), f"{raw}/{table}")
    lake.load_silver(raw, [table])
    # Two versions end at one time now.
    assert lake.silver(table).count() == 3 and lake._changes(table)[0].filter("sub_total = 7").count() == 1


def _gold(spark):
    n = None
    header = spark.createDataFrame(
        [
            (1, True, True, Decimal("100"), Decimal("10"), Decimal("5"), 7, 1, 1, "SO1"),
            (2, False, True, Decimal("100"), Decimal("10"), Decimal("5"), 7, 1, 1, "SO2"),
            (3, True, True, Decimal("0"), Decimal("10"), Decimal("5"), 7, 1, 1, "SO3"),
            (4, True, True, Decimal("50"), Decimal("1"), Decimal("1"), 7, 99, n, "SO4"),
            (5, True, True, Decimal("50"), Decimal("1"), Decimal("1"), 8, 1, n, "SO5"),
        ],
        "sales_order_id int, online_order_flag boolean, is_current boolean, sub_total decimal(19,4), "
        "tax_amt decimal(19,4), freight decimal(19,4), customer_id int, territory_id int, "
        "currency_rate_id int, sales_order_number string",
    ).withColumns(
        {
            "revision_number": F.lit(1).cast("tinyint"),
            "purchase_order_number": F.lit("po"),
            **{c: F.lit(datetime(2024, 3, 15)) for c in ("order_date", "due_date", "ship_date")},
        }
    )
    detail = spark.createDataFrame(
        [(1, 43659, 1, 1, 2, Decimal("20"), Decimal("0.1"), Decimal("36")), (1, 43660, 5, 2, 1, Decimal("64"), Decimal("0"), Decimal("64"))]
        + [(o, 1, 1, 1, 1, Decimal("50"), Decimal("0"), Decimal("50")) for o in (2, 3, 4, 5)],
        "sales_order_id int, sales_order_detail_id int, product_id int, special_offer_id int, order_qty int, "
        "unit_price decimal(19,4), unit_price_discount decimal(19,4), line_total decimal(19,4)",
    ).withColumn("carrier_tracking_number", F.lit("c")).withColumn("order_qty", F.col("order_qty").cast("smallint"))
    dims = {
        "product": spark.createDataFrame([(1, Decimal("7"), None), (5, Decimal("3"), "Unknown")], "ProductKey int, StandardCost decimal(19,4), ProductLine string"),
        "customer": spark.createDataFrame([(7, True), (8, False)], "CustomerKey int, is_current boolean"),
        "promotion": spark.createDataFrame([(1,)], "PromotionKey int"),
        "currency_rate": spark.createDataFrame([(1, "EUR")], "currency_rate_id int, to_currency_code string"),
        "currency": spark.createDataFrame([("EUR",)], "currency_code string"),
        "territory": spark.createDataFrame([(1, "FR", "Europe")], "sales_territory_id int, sales_country_region_code string, sales_group_name string"),
    }
    return header, detail, dims


def test_fact_and_month(spark):
    header, detail, dims = _gold(spark)
    fact = fact_sales(header, detail, None, **dims)
    lines = {(r.SalesOrderNumber, r.SalesOrderLineNumber): r for r in fact.collect()}
    # Offline, empty and territory-less orders are out.
    assert set(lines) == {("SO1", 43659), ("SO1", 43660), ("SO5", 1)}
    one = lines["SO1", 43659]
    assert (one.DiscountAmount, one.SalesAmount, one.TotalProductCost) == (4.0, Decimal("36.0000"), Decimal("14.0000"))
    assert (one.TaxAmt, one.Freight, one.OrderDateKey) == (Decimal("3.6000"), Decimal("1.8000"), 20240315)
    assert (one.CurrencyKey, one.PromotionKey, one.CustomerKey) == ("EUR", 1, 7)
    assert lines["SO1", 43660].PromotionKey is None
    assert (lines["SO5", 1].CustomerKey, lines["SO5", 1].CurrencyKey) == (None, None)

    month = agg_monthly_sales(fact, dims["territory"], dims["product"], "2024-04-01")
    got = {(r.ProductLine, r.TotalOrders): r for r in month.collect()}
    # NULL and a line called Unknown are two rows with one label.
    assert set(got) == {("Unknown", 2), ("Unknown", 1)}
    assert got["Unknown", 2].TotalSalesAmount == Decimal("86.00")
    assert got["Unknown", 1].GrossMarginPct == Decimal("95.31")
    served = as_serving(month, SERVING_SCHEMA)
    path = work_path(spark, "export")
    assert export_parquet(served, path) == 2 and export_parquet(served, path) == 2
    assert rows(read_export(spark, path, SERVING_SCHEMA)) == rows(served)


def test_fact_in_steps(spark):
    """The same lines, also of orders and details that come twice; no shuffle file
    stays, and no copy but the one that is kept."""
    header, detail, dims = _gold(spark)
    header, detail = header.union(header.filter("sales_order_id = 5")), detail.union(detail.limit(1))
    want = rows(fact_sales(header, detail, None, **dims))
    assert len(want) == 5
    work, left = f"{shared_dir(spark)}/work", shuffle_files(spark)
    before = set(os.listdir(work)) if os.path.exists(work) else set()
    with scratch() as keep:
        kept = keep(stage(fact_sales(header, detail, None, **dims, steps=True), "kept", release=True))
    assert {d.split("-")[0] for d in set(os.listdir(work)) - before} == {"kept"}
    assert shuffle_files(spark) <= left
    assert rows(kept) == want
    changes = header.filter("sales_order_id = 1")
    assert rows(fact_sales(header, detail, changes, **dims, steps=True)) == rows(fact_sales(header, detail, changes, **dims))


def test_fact_load_is_repeatable(spark):
    header, detail, dims = _gold(spark)
    changes = header.filter("sales_order_id = 5")
    everything = fact_sales(header, detail, None, **dims)
    target = everything.limit(0).withColumn("ingestion_timestamp", F.lit(None).cast("timestamp"))
    first = fact_load(target, everything, "2024-01-01")
    dearer = detail.withColumn("unit_price", F.col("unit_price") * 2)
    second = fact_load(first, fact_sales(header, dearer, changes, **dims), "2024-02-01")
    got = {(r.SalesOrderNumber, r.SalesOrderLineNumber): (r.UnitPrice, r.ingestion_timestamp.month) for r in second.collect()}
    assert got == {("SO1", 43659): (20, 1), ("SO1", 43660): (64, 1), ("SO5", 1): (100, 2)}


def test_customer_changed_twice_and_several_contacts(spark):
    stamps = "modified_date timestamp, end_date timestamp, is_current boolean, _change_type string, _commit_version int"
    t = [datetime(2020, 1, d) for d in range(1, 9)]
    changes = spark.createDataFrame(
        [
            (1, 11, "alt-9", t[1], None, True, "insert", 9),
            (1, 11, "alt-10", t[2], None, True, "update_postimage", 10),
            (1, 11, "alt-9", t[1], t[2], False, "update_postimage", 10),
            (1, 11, "alt-9", t[1], None, True, "update_preimage", 10),
            (2, None, "b", t[3], None, True, "insert", 9),
        ],
        f"customer_id int, person_id int, account_number string, {stamps}",
    )
    person = spark.createDataFrame(
        [(11, None, "Ann", None, "B", False, None, "<IndividualSurvey><Education>Bachelors</Education></IndividualSurvey>", True)],
        "business_entity_id int, title string, first_name string, middle_name string, last_name string, "
        "name_style boolean, suffix string, demographics string, is_current boolean",
    )
    email = spark.createDataFrame([(11, 1, "one", True), (11, 2, "two", True), (11, 3, "old", False)], "business_entity_id int, email_address_id int, email_address string, is_current boolean")
    phone = spark.createDataFrame([(11, 1, "p1", True)], "business_entity_id int, phone_number_type_id int, phone_number string, is_current boolean")
    place = spark.createDataFrame([(11, 1, 5, True)], "business_entity_id int, address_type_id int, address_id int, is_current boolean")
    address = spark.createDataFrame([(5, "Road", None, True)], "address_id int, address_line1 string, address_line2 string, is_current boolean")
    found = customer_enriched(changes, person, email, phone, place, address, education(spark), occupation(spark))
    assert found.count() == 4
    empty = found.limit(0)
    cur = empty.drop("valid_to", "_commit_version").withColumn("ingestion_timestamp", F.lit(None).cast("timestamp"))
    hist = empty.drop("_commit_version").withColumns(
        {"closed_timestamp": F.lit(None).cast("timestamp"), "ingestion_timestamp": F.lit(None).cast("timestamp"), "year_valid_to": F.lit(0)}
    )
    dim, history = dim_customer_load(cur, hist, found, "2024-01-01")
    got = {r.CustomerKey: r for r in dim.collect()}
    assert got[1].valid_from == t[2] and got[1].EmailAddress == "two" and got[1].SpanishEducation == "Licenciatura"
    assert got[1].GeographyKey == 5 and got[2].FirstName is None
    assert [(r.CustomerKey, r.valid_from, r.valid_to, r.year_valid_to) for r in history.collect()] == [(1, t[1], t[2], 2020)]
    # A second run changes no key, adds no history and leaves the alternate key.
    again, history2 = dim_customer_load(dim, history, found.withColumn("CustomerAlternateKey", F.lit("NEW")), "2024-02-01")
    assert {r.CustomerKey: r.CustomerAlternateKey for r in again.collect()} == {1: "alt-10", 2: "b"}
    assert history2.count() == 1


def test_reason_load_twice(spark):
    silver = spark.createDataFrame([(1, "a", "x", True), (1, "b", "x", False), (None, "c", "x", True)], "sales_reason_id int, name string, reason_type string, is_current boolean")
    empty = spark.createDataFrame([], "sales_reason_id int, sales_reason_name string, sales_reason_type string, ingestion_timestamp timestamp, sales_reason_state boolean")
    once = load_dim_reason(empty, silver)
    assert once.count() == 2 and load_dim_reason(once, silver).count() == 2


def test_cluster_spreads_a_hot_value_and_narrows_files(spark):
    """One value holds most rows, all of them copies; no file gets them all."""
    df = spark.createDataFrame([(1, "x")] * 3000 + [(i, str(i)) for i in range(1000)], "k int, s string").repartition(8)
    spread = cluster(df, ["k"], 8).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in spread) < 1500
    grid = spark.range(40_000).select((F.col("id") % 200).alias("a"), (F.col("id") / 200).cast("int").alias("b"))
    boxes = cluster(grid, ["a", "b"], 16).groupBy(F.spark_partition_id()).agg(F.max("a") - F.min("a"), F.max("b") - F.min("b")).collect()
    assert len(boxes) > 8 and sum(r[1] < 150 for r in boxes) > 8 and sum(r[2] < 150 for r in boxes) > 8
    assert cluster(grid, ["a", "b"], 16).distinct().count() == 40_000


def test_partition_pruning(spark):
    path = work_path(spark, "parts")
    write_partitioned(spark.range(100).withColumn("p", F.col("id") % 4), path, ["p"])
    one = spark.read.parquet(path).filter("p = 2")
    assert one.count() == 25
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_counts_and_probe(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "d")], "i int, x string")
    assert rows(count_tables({"a": df, "b": df.limit(0)})) == [("a", 3), ("b", 0)]
    assert rows(probe_text(df, ["i"], "x", order=["i"])) == [(1, 3), (3, 1)]


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_cluster_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(5000).selectExpr("id", "id % 70 AS g").mapInArrow(count, "id long, g long")
    assert cluster(df, ["id", "g"], 4).count() == 5000 and seen.value == 5000


def test_cluster_tells_texts_with_a_common_start_apart(spark):
    df = spark.range(20_000).selectExpr("concat('Customer#0000', lpad(id, 9, '0')) AS a", "hash(id) AS b")
    spread = cluster(df, ["a", "b"], 64).groupBy(F.spark_partition_id()).agg(F.min("a"), F.max("a")).collect()
    width = [int(r[2][-9:]) - int(r[1][-9:]) for r in spread]
    assert sorted(width)[len(width) // 2] < 20_000 / 4
