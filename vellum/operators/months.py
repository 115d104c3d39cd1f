"""Month slices, month counts and the contiguous-month load.

The warehouse loads a fact month by month from January of a year, in
calendar order and across the year's end, and stops before the first month
without rows; later months are ignored even when they have rows. Here that
loop is one plan:

1. one scan filtered by ``d >= first of January`` (pushed to the scan);
2. a partial aggregate to one row per (key, month) -- the only data that
   crosses the first shuffle, whatever the fact size or key skew;
3. gaps-and-islands over those month rows: month index minus its rank is 0
   exactly for the unbroken run that starts at January (un-keyed, this window
   has no partition key but sees at most one row per calendar month, so the
   fact is still scanned once -- a first-gap scalar subquery would rescan it);
4. un-keyed, a filter by the end of that run (a scalar); keyed, a left-semi
   join of the fact with the kept (key, month) pairs.

Step 3 sees at most (#keys x #months in the data's span) rows; un-keyed, it
is one row per month. A keyed step 4 joins on (key, month), so a hot key's
rows are spread over its months instead of landing in one task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions.dates import month_floor, month_index, month_range

MONTH_IDX = "month_idx"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_slice(df: DataFrame, date_col: str, year: int, month: int) -> DataFrame:
    """Rows whose ``date_col`` falls in (year, month); a half-open range."""
    return df.where(month_range(date_col, year, month))


def month_counts(df: DataFrame, date_col: str, keys: list[str] | tuple = ()) -> DataFrame:
    """Rows per calendar month (``month`` = first day), NULL dates excluded."""
    return (
        df.where(F.col(date_col).isNotNull())
        .groupBy(*keys, month_floor(date_col).alias("month"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _since(date_col: str, year: int) -> Column:
    # Same type on both sides keeps the bound a pushed scan filter.
    return F.col(date_col) >= F.lit(_dt.date(year, 1, 1))


def kept_months(df: DataFrame, date_col: str, year: int, keys: list[str] | tuple = ()) -> DataFrame:
    """(keys..., month_idx, month, rows) for the unbroken run of months from January.

    Un-keyed: one run for the whole table. Keyed: one run per key. A key (or
    the table) whose January is empty keeps no month.
    """
    keys = list(keys)
    counts = (
        df.where(_since(date_col, year))
        .select(*keys, month_index(date_col, year, 1).alias(MONTH_IDX))
        .groupBy(*keys, MONTH_IDX)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    # At most one row per month of the span per key (bounded after step 2).
    w = Window.partitionBy(*keys).orderBy(MONTH_IDX) if keys else Window.orderBy(MONTH_IDX)
    kept = counts.withColumn("_rn", F.row_number().over(w) - 1).where(F.col(MONTH_IDX) == F.col("_rn")).drop("_rn")
    start = _dt.date(year, 1, 1)
    return kept.withColumn("month", F.add_months(F.lit(start), F.col(MONTH_IDX).cast("int")))


def month_prefix_summary(df: DataFrame, date_col: str, year: int) -> DataFrame:
    """One row ``(total_rows, months_processed, year)``; also when nothing loads."""
    kept = kept_months(df, date_col, year)
    return kept.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).cast("bigint").alias("months_processed"),
        F.lit(year).alias("year"),
    )


def month_prefix_by_key(df: DataFrame, date_col: str, year: int, keys: list[str]) -> DataFrame:
    """Per key: ``(keys..., total_rows, months_processed)`` of its unbroken run."""
    kept = kept_months(df, date_col, year, keys)
    return kept.groupBy(*keys).agg(
        F.sum("rows").cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).cast("bigint").alias("months_processed"),
    )


def kept_until(df: DataFrame, date_col: str, year: int) -> DataFrame:
    """One row ``until``: the first day after the unbroken run of months; NULL when January is empty."""
    last = F.max(MONTH_IDX).cast("int")
    return kept_months(df, date_col, year).agg(F.add_months(F.lit(_dt.date(year, 1, 1)), last + 1).alias("until"))


def load_contiguous_months(df: DataFrame, date_col: str, year: int, keys: list[str] | tuple = ()) -> DataFrame:
    """Fact rows in the kept months, with ``month`` (first day) added.

    Un-keyed, the kept months are an interval from January on, so the rows are
    those before its end: a one-row scalar, no join. Keyed, every key has its
    own end; the kept (key, month) pairs are joined, and a hot key's rows are
    spread over its months.
    """
    keys = list(keys)
    since = df.where(_since(date_col, year))
    if not keys:
        rows = since.where(F.col(date_col) < kept_until(df, date_col, year).scalar())
    else:
        kept = kept_months(df, date_col, year, keys).select(*keys, MONTH_IDX)
        rows = since.withColumn(MONTH_IDX, month_index(date_col, year, 1)).join(kept, on=[*keys, MONTH_IDX], how="left_semi").drop(MONTH_IDX)
    return rows.withColumn("month", month_floor(date_col))
