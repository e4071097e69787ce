"""Money and ratio expressions on decimals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(19,4)"


def money(c: Column) -> Column:
    """Non-negative amount with four decimals; unreadable text gives NULL."""
    return F.abs(c.try_cast(MONEY))


def share(whole: Column, part: Column, total: Column) -> Column:
    """``whole`` allocated by part / total, four decimals; total 0 gives NULL."""
    return F.round(whole * (part / F.nullif(total, F.lit(0))), 4)


def pct(part: Column, total: Column) -> Column:
    """part / total in percent, two decimals; total 0 gives NULL."""
    return F.round(part / F.nullif(total, F.lit(0)) * 100, 2)
