"""Month arithmetic as Column expressions.

A month slice is written as a half-open range on the date column, never as
``year(d) = y and month(d) = m``: the range form reaches the Parquet and JDBC
scans as pushed filters, the function form only as ``IsNotNull``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(year: int, month: int) -> _dt.date:
    return _dt.date(year, month, 1)


def add_months(d: _dt.date, n: int) -> _dt.date:
    k = d.year * 12 + (d.month - 1) + n
    return _dt.date(k // 12, k % 12 + 1, 1)


def next_month(year: int, month: int) -> tuple[int, int]:
    """The month after (year, month); always the following calendar month."""
    d = add_months(month_start(year, month), 1)
    return d.year, d.month


def month_range(c: Column | str, year: int, month: int, n_months: int = 1) -> Column:
    """``c`` falls in [first of (year, month), first of the month n later)."""
    lo = month_start(year, month)
    hi = add_months(lo, n_months)
    col = _col(c)
    return (col >= F.lit(lo)) & (col < F.lit(hi))


def month_floor(c: Column | str) -> Column:
    """First day of the month of ``c`` as a date."""
    return F.trunc(F.to_date(_col(c)), "month")


def month_index(c: Column | str, year: int, month: int = 1) -> Column:
    """Whole months from (year, month) to the month of ``c`` (0 = that month)."""
    col = F.to_date(_col(c))
    return (F.year(col) - F.lit(year)) * 12 + (F.month(col) - F.lit(month))
