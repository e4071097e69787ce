"""The whole load: raw text -> cleaned history -> dimensions, fact, aggregate.

Tables are versioned folders below one root. Every step may be repeated: what
was loaded before changes nothing. Histories, the fact and the monthly aggregate
are dealt to slots, and a load reads and writes only the slots it touches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.changes import empty_control, get_watermark, next_start, post_images, set_watermark
from tidemark.operators.joins import LookUps
from tidemark.operators.malformed import well_formed
from tidemark.operators.scd2 import LOAD_COL
from tidemark.operators.upsert import assert_unique, restrict_to_keys
from tidemark.plans import dimensions as dims
from tidemark.plans.customer import customer_enriched, dim_customer_load
from tidemark.plans.fact import FACT_KEYS, changed_orders, fact_load, fact_sales, months_of_orders
from tidemark.plans.gold import empty_gold
from tidemark.plans.monthly import SERVING_SCHEMA, agg_monthly_sales
from tidemark.plans.product import load_dim_product, load_dim_product_history, product_enriched
from tidemark.plans.raw import RAW_COLUMNS, read_raw
from tidemark.plans.silver import (
    DAY_GRAIN,
    HISTORIES,
    INSERT_ONLY,
    ORDER,
    clean,
    empty_silver,
    load_silver,
    malformed_rows,
    rejected_rows,
    unseen_rows,
)
from tidemark.session import scratch, stage
from tidemark.sources.export import publish
from tidemark.sources.lookup import education, occupation
from tidemark.sources.snapshots import (
    Slots,
    append,
    append_slots,
    changed_slots,
    compact_slots,
    last_version,
    latest_version,
    read_snapshot,
    replace,
    replace_slots,
    versions,
)
from tidemark.streaming.incremental import pull_changes

FACT, MONTHLY, CONTROL = "gold/fact_internet_sales", "gold/agg_monthly_sales", "gold/pipeline_control"
FACT_SLOTS = Slots.by_month("OrderDateKey")
MONTHLY_SLOTS = Slots.by_year_and_month("OrderYear", "OrderMonth")
# What the monthly aggregate takes from its look-ups.
_LOOKED_UP = {
    "dim_product": ("ProductKey", ["ProductLine"]),
    "dim_sales_territory": ("sales_territory_id", ["sales_country_region_code", "sales_group_name"]),
}
_FACT_KEY = {"dim_product": "ProductKey", "dim_sales_territory": "SalesTerritoryKey"}


class Lakehouse:
    """Loads below ``root``.

    ``slots`` is the number of folders that a history is dealt to by its key;
    choose it once, so that one holds about a gigabyte. ``files`` is the number
    of files per clustered table, and of a month of the fact. ``as_of`` replaces
    the clock where a run must be repeatable. ``looked_up`` has what the look-ups
    of the last fact load did (:class:`LookUps`).
    """

    def __init__(
        self, spark: SparkSession, root: str, files: int = 8, as_of: datetime | str | None = None, slots: int = 8
    ):
        self.spark, self.root, self.files, self.as_of, self.slots = spark, root.rstrip("/"), files, as_of, slots
        self.looked_up: dict[str, dict[str, int]] = {}

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def silver(self, table: str) -> DataFrame:
        return self._read(f"silver/{table}", lambda: empty_silver(self.spark, table))

    def gold(self, table: str) -> DataFrame:
        return self._read(f"gold/{table}", lambda: empty_gold(self.spark, table))

    def _read(self, table: str, empty: Callable[[], DataFrame]) -> DataFrame:
        known = latest_version(self.spark, self.path(table)) is not None
        return read_snapshot(self.spark, self.path(table)) if known else empty()

    def _store(self, table: str, df: DataFrame, **layout) -> None:
        replace(df, self.path(table), **layout)

    def load_silver(self, raw_root: str, tables: Iterable[str] = RAW_COLUMNS) -> None:
        """Load the raw text below ``raw_root``, one folder per table."""
        for table in tables:
            with scratch():
                raw = stage(read_raw(self.spark, table, f"{raw_root}/{table}", lines=True), "raw")
                bad = stage(malformed_rows(raw, table, self.as_of), "malformed")
                if not bad.isEmpty():
                    append(bad, self.path(f"malformed/{table}"))
                load = self._load_new if table in INSERT_ONLY else self._load_history
                load(table, well_formed(raw))

    def _slots(self, table: str) -> Slots:
        """Tables are dealt by their first key, so that lines lie like their orders."""
        keys = INSERT_ONLY[table] if table in INSERT_ONLY else HISTORIES[table].keys
        return Slots.by_hash(keys[:1], self.slots)

    def _touched(self, table: str, rows: DataFrame) -> tuple[list[int], DataFrame]:
        """Slots that ``rows`` belong to, and what the table holds in them."""
        empty, path = empty_silver(self.spark, table), self.path(f"silver/{table}")
        touched = self._slots(table).touched(rows, empty.schema)
        known = latest_version(self.spark, path) is not None
        return touched, read_snapshot(self.spark, path, slots=touched) if known else empty

    def _load_new(self, table: str, raw: DataFrame) -> None:
        """Add the rows with unseen keys; only these are written."""
        _, target = self._touched(table, clean(raw, table))
        path, layout = self.path(f"silver/{table}"), {"sort_by": INSERT_ONLY[table]}
        append_slots(unseen_rows(target, raw, table, self.as_of), path, self._slots(table), **layout)
        compact_slots(self.spark, path, self._slots(table), **layout)

    def _load_history(self, table: str, raw: DataFrame) -> None:
        rejects = stage(rejected_rows(raw, table, self.as_of), "rejects")
        if not rejects.isEmpty():
            append(rejects, self.path(f"rejects/{table}"))
        touched, target = self._touched(table, clean(raw, table, every_version=True))
        state = load_silver(target, raw, table, self.as_of, every_version=True, feed=True)
        replace_slots(
            state, self.path(f"silver/{table}"), self._slots(table), touched, sort_by=HISTORIES[table].cluster_by
        )

    def load_dimensions(self) -> None:
        s, g, at = self.silver, self.gold, self.as_of
        new = {
            "dim_currency": dims.load_dim_currency(g("dim_currency"), s("sales_currency"), at),
            "dim_geography": dims.load_dim_geography(
                g("dim_geography"), s("person_address"), s("person_stateprovince"), s("person_countryregion"), at
            ),
            "dim_sales_territory": dims.load_dim_territory(g("dim_sales_territory"), s("sales_salesterritory"), at),
            "dim_product_category": dims.load_dim_category(g("dim_product_category"), s("production_productcategory"), at),
            "dim_product_sub_category": dims.load_dim_subcategory(
                g("dim_product_sub_category"), s("production_productsubcategory"), at
            ),
            "dim_promotion": dims.load_dim_promotion(g("dim_promotion"), s("sales_specialoffer")),
            "dim_sales_reason": dims.load_dim_reason(g("dim_sales_reason"), s("sales_salesreason"), at),
        }
        product = stage(
            product_enriched(
                s("production_product"), s("production_productmodel"), s("production_productproductphoto"), s("production_productphoto")
            ),
            "products",
        )
        new["dim_product"] = load_dim_product(g("dim_product"), product, at)
        for table, df in new.items():
            self._store(f"gold/{table}", df)
        history = load_dim_product_history(g("dim_product_history"), product, at)
        self._store("gold/dim_product_history", history, partition_by=["year_valid_to"])
        self._store("gold/dim_date", dims.dim_date(self.spark))

    def _control(self) -> DataFrame:
        return self._read(CONTROL, lambda: empty_control(self.spark))

    def _changes(self, table: str, stores: Sequence[str] = ()) -> tuple[DataFrame | None, DataFrame, str]:
        """Changes that the ``stores`` have not all taken in, the next control, and
        the note under which the stores take them.

        A run that broke off after some of its stores left its note there: the
        next run takes the same changes again, and only the other stores do.
        """
        control = self._control()
        start, end = next_start(control, table), None
        for store in stores:
            last = last_version(self.spark, self.path(store))
            found = last and re.fullmatch(rf"{table} {start} to (\d+)", last.note)
            end = int(found[1]) if found else end
        # A correction may keep its date; the load stamp tells the rows apart.
        row = [*HISTORIES[table].keys, ORDER, LOAD_COL]
        # Versions of one day and load are told apart by their ends.
        among = ["end_date"] if table in DAY_GRAIN else []
        feed, after = pull_changes(self.spark, control, table, self.path(f"silver/{table}"), row, self.as_of, among, end)
        return feed, after, f"{table} {start} to {get_watermark(after, table)}"

    def _done(self, store: str, note: str) -> bool:
        last = last_version(self.spark, self.path(store))
        return last is not None and last.note == note

    def load_customers(self) -> bool:
        """Bring the customer dimension and its history up to the customer table."""
        history_path, path = "gold/dim_customer_history", "gold/dim_customer"
        with scratch():
            feed, control, note = self._changes("sales_customer", [history_path, path])
            if feed is None:
                return False
            s = self.silver
            # The dimension is stored last: what it was is what the history needs.
            if not self._done(path, note):
                enriched = stage(
                    customer_enriched(
                        feed, s("person_person"), s("person_emailaddress"), s("person_personphone"),
                        s("person_businessentityaddress"), s("person_address"),
                        education(self.spark), occupation(self.spark),
                    ),
                    "customers",
                )
                now, history = dim_customer_load(
                    self.gold("dim_customer"), self.gold("dim_customer_history"), enriched, self.as_of
                )
                if not self._done(history_path, note):
                    self._store(history_path, history, partition_by=["year_valid_to"], note=note)
                self._store(path, now, cluster_by=["CustomerKey"], files=self.files, note=note)
            self._store(CONTROL, control)
        return True

    def load_fact(self) -> bool:
        """Recompute the orders whose header changed and merge their lines into
        the months they belong to, and those they belonged to before."""
        with scratch():
            feed, control, note = self._changes("sales_salesorderheader", [FACT])
            if feed is None:
                return False
            if not self._done(FACT, note):
                # Headers and lines of an order lie in slots of the same number.
                changed, report = changed_orders(feed), LookUps()
                lines = stage(
                    fact_sales(
                        self._touched("sales_salesorderheader", changed)[1],
                        self._touched("sales_salesorderdetail", changed)[1],
                        post_images(feed),
                        product=self.gold("dim_product"),
                        customer=self.gold("dim_customer"),
                        promotion=self.gold("dim_promotion"),
                        currency_rate=self.silver("sales_currencyrate"),
                        currency=self.gold("dim_currency"),
                        territory=self.gold("dim_sales_territory"),
                        report=report,
                    ),
                    "fact-lines",
                )
                # Nothing is stored of a load whose look-ups multiply its lines.
                self.looked_up = report.check()
                assert_unique(lines, FACT_KEYS, "the fact's lines")
                path, empty = self.path(FACT), empty_gold(self.spark, "fact_internet_sales")
                days = months_of_orders(feed).union(lines.select("OrderDateKey"))
                touched = FACT_SLOTS.touched(days, empty.schema)
                known = latest_version(self.spark, path) is not None
                target = read_snapshot(self.spark, path, slots=touched) if known else empty
                fact = fact_load(target, lines, self.as_of, checked=True)
                replace_slots(
                    fact, path, FACT_SLOTS, touched, note, sort_by=["CustomerKey", "ProductKey"], cells=self.files
                )
            self._store(CONTROL, control)
        return True

    def _changed_months(self, control: DataFrame) -> tuple[list[int] | None, dict[str, int]]:
        """Months whose aggregate may have changed since the control rows of the
        monthly table (None: all), and the versions that are read now."""
        read = {t: latest_version(self.spark, self.path(f"gold/{t}")) for t in ("fact_internet_sales", *_LOOKED_UP)}
        seen = {t: get_watermark(control, f"agg_monthly_sales of {t}") for t in read}
        if None in seen.values() or latest_version(self.spark, self.path(MONTHLY)) is None:
            return None, read
        months = set(changed_slots(self.spark, self.path(FACT), seen["fact_internet_sales"] + 1))
        for table, (key, values) in _LOOKED_UP.items():
            if read[table] == seen[table]:
                continue
            path = self.path(f"gold/{table}")
            if seen[table] not in versions(self.spark, path, seen[table], seen[table]):
                return None, read
            # Rows that only one of the two versions has.
            old, new = (read_snapshot(self.spark, path, v).select(key, *values) for v in (seen[table], read[table]))
            changed = old.exceptAll(new).union(new.exceptAll(old)).select(F.col(key).alias(_FACT_KEY[table]))
            sold = restrict_to_keys(self.gold("fact_internet_sales"), stage(changed, "changed-keys"), [_FACT_KEY[table]])
            months |= set(FACT_SLOTS.touched(sold, sold.schema))
        return sorted(months), read

    def load_monthly(self) -> list[int] | None:
        """Aggregate the months whose facts or look-ups changed since the last
        load, and leave the others where they are. Returns these months, None
        for all."""
        with scratch():
            control = self._control()
            months, read = self._changed_months(control)
            if months == []:
                return months
            monthly = agg_monthly_sales(
                read_snapshot(self.spark, self.path(FACT), slots=months),
                self.gold("dim_sales_territory"),
                self.gold("dim_product"),
                self.as_of,
            )
            # A month of rows without a date is NULL in the aggregate and slot 0.
            replace_slots(monthly, self.path(MONTHLY), MONTHLY_SLOTS, months, sort_by=["CountryRegionCode"])
            for table, version in read.items():
                if version is not None:
                    control = set_watermark(control, f"agg_monthly_sales of {table}", version, self.as_of)
            self._store(CONTROL, control)
        return months

    def export(self, path: str) -> int:
        """Publish the monthly aggregate for the serving engine; returns its rows.
        A reader of the export before keeps its folder."""
        monthly = read_snapshot(self.spark, self.path(MONTHLY))
        return publish(monthly, path, SERVING_SCHEMA).rows

    def load_all(self, raw_root: str, tables: Iterable[str] = RAW_COLUMNS) -> None:
        self.load_silver(raw_root, tables)
        self.load_dimensions()
        self.load_customers()
        self.load_fact()
        self.load_monthly()
