"""Contiguous month prefix (keyed) against a brute-force loop on a small fixture."""

import datetime as dt
import random

from vellum.operators.months import (
    load_contiguous_months,
    month_counts,
    month_prefix_by_key,
    month_slice,
)


def brute(rows, year):
    by_key = {}
    for k, d in rows:
        if d is not None:
            by_key.setdefault(k, []).append(d)
    out = {}
    for k, ds in by_key.items():
        y, m, total, months = year, 1, 0, 0
        while True:
            n = sum(1 for d in ds if d.year == y and d.month == m)
            if n == 0:
                break
            total, months = total + n, months + 1
            y, m = (y + 1, 1) if m == 12 else (y, m + 1)
        if months:
            out[k] = (total, months)
    return out


def test_keyed_prefix_matches_loop(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(30):
        for _ in range(rnd.randint(0, 40)):
            y = rnd.choice([2024, 2025, 2025, 2025, 2026])
            rows.append((k, dt.date(y, rnd.randint(1, 12), rnd.randint(1, 28))))
    rows.append((99, None))
    # A hot key with every month of 2025 and 2026.
    rows += [(0, dt.date(y, m, 1)) for y in (2025, 2026) for m in range(1, 13) for _ in range(20)]
    df = spark.createDataFrame(rows, "k bigint, d date")
    got = {r.k: (r.total_rows, r.months_processed) for r in month_prefix_by_key(df, "d", 2025, ["k"]).collect()}
    assert got == brute(rows, 2025)
    loaded = load_contiguous_months(df, "d", 2025, ["k"]).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in loaded} == {k: v[0] for k, v in got.items()}


def test_month_slice_and_counts_on_timestamps(spark):
    rows = [(dt.datetime(2025, 3, 31, 23, 59),), (dt.datetime(2025, 4, 1, 0, 0),), (None,)]
    df = spark.createDataFrame(rows, "d timestamp_ntz")
    assert month_slice(df, "d", 2025, 3).count() == 1
    got = {r.month: r.rows for r in month_counts(df, "d").collect()}
    assert got == {dt.date(2025, 3, 1): 1, dt.date(2025, 4, 1): 1}


def test_next_month_equals_day5_plus_30_days():
    from vellum.functions.dates import next_month

    for y in (1900, 1999, 2000, 2024, 2025, 2100):
        for m in range(1, 13):
            d = dt.date(y, m, 5) + dt.timedelta(days=30)
            assert next_month(y, m) == (d.year, d.month)


def test_month_range_across_year_end(spark):
    from vellum.functions.dates import month_range

    df = spark.createDataFrame(
        [(dt.date(2025, 12, 31),), (dt.date(2026, 1, 1),), (dt.date(2026, 2, 28),), (dt.date(2026, 3, 1),)], "d date"
    )
    assert df.where(month_range("d", 2025, 12, 3)).count() == 3
