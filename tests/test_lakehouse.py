"""Raw text to exported aggregate, twice."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from tests.conftest import rows
from tidemark.plans.lakehouse import Lakehouse
from tidemark.plans.raw import CONTROL_A_TABLES, RAW_COLUMNS
from tidemark.session import work_path

DAY = "2024-03-01 00:00:00"
FIRST = {
    "sales_salesorderheader": [
        {"SalesOrderID": 1, "RevisionNumber": 1, "OrderDate": DAY, "DueDate": DAY, "ShipDate": DAY, "Status": 5,
         "OnlineOrderFlag": "true", "SalesOrderNumber": "SO1", "CustomerID": 7, "TerritoryID": 1, "CurrencyRateID": 1,
         "SubTotal": 100, "TaxAmt": 10, "Freight": 5, "TotalDue": 115, "ModifiedDate": DAY},
    ],
    "sales_salesorderdetail": [
        {"SalesOrderID": 1, "SalesOrderDetailID": 43659, "OrderQty": 2, "ProductID": 3, "SpecialOfferID": 1,
         "UnitPrice": 50, "UnitPriceDiscount": 0, "LineTotal": 100, "ModifiedDate": DAY},
    ],
    "sales_customer": [{"CustomerID": 7, "PersonID": 11, "TerritoryID": 1, "AccountNumber": "AW7", "ModifiedDate": DAY}],
    "person_person": [
        {"BusinessEntityID": 11, "FirstName": "Ann", "Demographics": "<IndividualSurvey><Gender>F</Gender></IndividualSurvey>", "ModifiedDate": DAY}
    ],
    "production_product": [{"ProductID": 3, "Name": "Bike", "StandardCost": 20, "ListPrice": 50, "ModifiedDate": DAY}],
    "sales_salesterritory": [{"TerritoryID": 1, "Name": "France", "CountryRegionCode": "FR", "Group": "Europe", "ModifiedDate": DAY}],
    "sales_specialoffer": [{"SpecialOfferID": 1, "Description": "none", "DiscountPct": 0, "ModifiedDate": DAY}],
    "sales_currency": [{"CurrencyCode": "EUR", "Name": "Euro", "ModifiedDate": DAY}],
    "sales_currencyrate": [{"CurrencyRateID": 1, "ToCurrencyCode": "EUR", "ModifiedDate": DAY}],
}
LATER = "2024-04-01 00:00:00"
SECOND = {
    "sales_salesorderheader": [{**FIRST["sales_salesorderheader"][0], "Status": 6, "Freight": 9, "TotalDue": 119, "ModifiedDate": LATER}],
    "sales_customer": [{**FIRST["sales_customer"][0], "AccountNumber": "AW8", "ModifiedDate": LATER}],
}


def write_raw(spark, tables) -> str:
    root = work_path(spark, "raw")
    for table, data in tables.items():
        names = [c.split(" ")[0] for c in RAW_COLUMNS[table].split(", ")]
        sep = "\x01" if table in CONTROL_A_TABLES else ","
        lines = [(sep.join(str(row.get(n, "null")) for n in names),) for row in data]
        spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{root}/{table}")
    return root


def test_two_loads(spark):
    root = work_path(spark, "lake")
    first = Lakehouse(spark, root, files=1, as_of="2024-03-02 00:00:00")
    first.load_all(write_raw(spark, FIRST), FIRST)
    line = first.gold("fact_internet_sales").first()
    assert (line.SalesOrderLineNumber, line.CustomerKey, line.CurrencyKey) == (43659, 7, "EUR")
    assert (line.SalesAmount, line.TotalProductCost, line.Freight) == (Decimal("100.0000"), Decimal("40.0000"), Decimal("5.0000"))

    second = Lakehouse(spark, root, files=1, as_of="2024-04-02 00:00:00")
    second.load_silver(write_raw(spark, SECOND), SECOND)
    assert second.load_customers() and second.load_fact()
    assert not second.load_customers() and not second.load_fact()
    second.load_monthly()
    line = second.gold("fact_internet_sales").collect()
    assert [(r.Freight, r.ingestion_timestamp) for r in line] == [(Decimal("9.0000"), datetime(2024, 4, 2))]
    assert rows(second.gold("dim_customer").select("CustomerKey", "CustomerAlternateKey", "Gender", "valid_from")) == [
        (7, "AW7", "F", datetime(2024, 4, 1))
    ]
    assert rows(second.gold("dim_customer_history").select("CustomerAlternateKey", "valid_to", "year_valid_to")) == [
        ("AW7", datetime(2024, 4, 1), 2024)
    ]
    assert second.export(work_path(spark, "export")) == 1
