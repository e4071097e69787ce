"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_key(c: Column) -> Column:
    """yyyyMMdd as an int, by arithmetic rather than by formatting text."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.day(c)


def fiscal_parts(c: Column, start_month: int = 7) -> dict[str, Column]:
    """Fiscal year, quarter and month; the year is named after its last month."""
    month = F.pmod(F.month(c) - start_month, F.lit(12)) + 1
    starts_earlier = start_month > 1
    year = F.year(c) + F.when(F.month(c) >= start_month, 1).otherwise(0) if starts_earlier else F.year(c)
    return {
        "fiscal_year": year.cast("int"),
        "fiscal_quarter": F.ceil(month / 3).cast("int"),
        "fiscal_month": month.cast("int"),
    }


def month_key(day_key: Column) -> Column:
    """yyyyMM of a yyyyMMdd key: a partition column with far fewer values."""
    return (day_key / 100).cast("int")
