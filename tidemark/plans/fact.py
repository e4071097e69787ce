"""Internet sales: one row per order line."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.calendar import date_key
from tidemark.functions.money import share
from tidemark.operators.joins import DimSpec, LookUps, star_join
from tidemark.operators.scd2 import load_stamp
from tidemark.operators.upsert import merge_upsert, restrict_to_keys
from tidemark.session import stage

FACT_KEYS = ["SalesOrderNumber", "SalesOrderLineNumber"]

# Fixed values. The line number stays an int: an order detail id does not fit a byte.
FACT_SCHEMA = (
    "ProductKey bigint, OrderDateKey int, DueDateKey int, ShipDateKey int, CustomerKey bigint, "
    "PromotionKey int, CurrencyKey string, SalesTerritoryKey int, SalesOrderNumber string, "
    "SalesOrderLineNumber int, RevisionNumber tinyint, OrderQuantity smallint, "
    "UnitPrice decimal(19,4), ExtendedAmount decimal(19,4), UnitPriceDiscountPct double, "
    "DiscountAmount double, ProductStandardCost decimal(19,4), TotalProductCost decimal(19,4), "
    "SalesAmount decimal(19,4), TaxAmt decimal(19,4), Freight decimal(19,4), "
    "CarrierTrackingNumber string, CustomerPONumber string, OrderDate timestamp, "
    "DueDate timestamp, ShipDate timestamp"
)
FACT_COLUMNS = dict(column.split(" ") for column in FACT_SCHEMA.split(", "))

# What the fact takes from an order's lines.
_DETAIL = (
    "sales_order_id", "sales_order_detail_id", "product_id", "special_offer_id", "order_qty", "unit_price",
    "unit_price_discount", "line_total", "carrier_tracking_number",
)


def changed_orders(changes: DataFrame) -> DataFrame:
    """Distinct online orders in a change feed of the order header."""
    return changes.filter("online_order_flag").select("sales_order_id").distinct()


def fact_sales(
    header: DataFrame,
    detail: DataFrame,
    changes: DataFrame | None,
    product: DataFrame,
    customer: DataFrame,
    promotion: DataFrame,
    currency_rate: DataFrame,
    currency: DataFrame,
    territory: DataFrame,
    report: LookUps | None = None,
    steps: bool = False,
) -> DataFrame:
    """Lines of the changed online orders (all of them when ``changes`` is
    None) with their keys and measures.

    Look-ups by order run before the lines are joined, on far fewer rows.
    Header tax and freight are allocated by line total / sub-total. ``report``
    counts what the look-ups drop or multiply.

    With ``steps`` the orders, and then the lines of these with their look-ups, are
    staged: the disk holds the shuffle files of one step at a time, and what is
    exchanged for the look-ups are lines without their order's columns. The result
    reads the copies (see :func:`tidemark.session.scratch`).
    """
    orders = header.filter(
        F.col("online_order_flag") & F.col("is_current") & (F.col("sub_total") > 0)
    )
    if changes is not None:
        orders = restrict_to_keys(orders, changed_orders(changes), ["sales_order_id"])
    orders = star_join(
        orders,
        [
            DimSpec(territory, {"territory_id": "sales_territory_id"}, {"SalesTerritoryKey": "sales_territory_id"}, required=True),
            DimSpec(customer, {"customer_id": "CustomerKey"}, {"CustomerKey": "CustomerKey"}, current_only=True),
            DimSpec(currency_rate, {"currency_rate_id": "currency_rate_id"}, {"_currency": "to_currency_code"}),
            DimSpec(currency, {"_currency": "currency_code"}, {"CurrencyKey": "currency_code"}),
        ],
        report,
    ).select(
        "sales_order_id", "SalesTerritoryKey", "CustomerKey", "CurrencyKey", "sales_order_number",
        "revision_number", "purchase_order_number", "order_date", "due_date", "ship_date",
        "sub_total", "tax_amt", "freight",
    )
    of_line = [
        DimSpec(product, {"product_id": "ProductKey"}, {"ProductKey": "ProductKey", "StandardCost": "StandardCost"}),
        DimSpec(promotion, {"special_offer_id": "PromotionKey"}, {"PromotionKey": "PromotionKey"}),
    ]
    if steps:
        orders = stage(orders, "orders", release=True)
        detail = restrict_to_keys(detail.select(*_DETAIL), orders, ["sales_order_id"])
        found = star_join(detail, of_line, report).drop("product_id", "special_offer_id")
        lines = orders.join(stage(found, "order-lines", release=True), "sales_order_id")
    else:
        lines = star_join(orders.join(detail, "sales_order_id"), of_line, report)
    price, off, qty = F.col("unit_price"), F.col("unit_price_discount"), F.col("order_qty")
    values = {
        "OrderDateKey": date_key(F.col("order_date")),
        "DueDateKey": date_key(F.col("due_date")),
        "ShipDateKey": date_key(F.col("ship_date")),
        "SalesOrderNumber": F.col("sales_order_number"),
        "SalesOrderLineNumber": F.col("sales_order_detail_id"),
        "RevisionNumber": F.col("revision_number"),
        "OrderQuantity": qty,
        "UnitPrice": price,
        "ExtendedAmount": F.col("line_total"),
        "UnitPriceDiscountPct": off,
        "DiscountAmount": F.round(price * off * qty, 4),
        "ProductStandardCost": F.col("StandardCost"),
        "TotalProductCost": F.round(F.col("StandardCost") * qty, 4),
        "SalesAmount": F.round(price * (1 - off) * qty, 4),
        "TaxAmt": share(F.col("tax_amt"), F.col("line_total"), F.col("sub_total")),
        "Freight": share(F.col("freight"), F.col("line_total"), F.col("sub_total")),
        "CarrierTrackingNumber": F.col("carrier_tracking_number"),
        "CustomerPONumber": F.col("purchase_order_number"),
        "OrderDate": F.col("order_date"),
        "DueDate": F.col("due_date"),
        "ShipDate": F.col("ship_date"),
    }
    return lines.select(
        *[values.get(c, F.col(c)).cast(kind).alias(c) for c, kind in FACT_COLUMNS.items()]
    )


def fact_load(
    target: DataFrame, lines: DataFrame, as_of: datetime | str | None = None, checked: bool = False
) -> DataFrame:
    """Merge fact lines by order and line number; ``checked`` lines come from
    :func:`tidemark.operators.upsert.merge_source` and are not stored again."""
    stamp = {"ingestion_timestamp": load_stamp(as_of)}
    return merge_upsert(target, lines, FACT_KEYS, stamp=stamp, checked=checked)


def months_of_orders(feed: DataFrame) -> DataFrame:
    """Order dates in a change feed of the order header, as ``OrderDateKey``: an
    order whose date changed was, until now, a fact of the date before."""
    return feed.filter("online_order_flag").select(date_key(F.col("order_date")).alias("OrderDateKey"))
