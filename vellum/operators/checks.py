"""Pre-checks: every check query must return at least one row.

Each check is read with ``limit(1)`` (a non-empty test, not a count), so the
cost of a check is at most one row per partition scanned until one is found.
Result: one row per check ``(check_name, passed)`` plus ``("all", bool_and)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_check(name: str, df: DataFrame) -> DataFrame:
    return (
        df.limit(1)
        .agg((F.count(F.lit(1)) > 0).alias("passed"))
        .select(F.lit(name).alias("check_name"), "passed")
    )


def pre_checks(checks: dict[str, DataFrame]) -> DataFrame:
    rows = reduce(DataFrame.unionByName, [_one_check(n, df) for n, df in checks.items()])
    # Grouping sets: every check's row and the verdict over all come from one reading of the checks.
    return rows.rollup("check_name").agg(F.bool_and("passed").alias("passed"), F.grouping("check_name").alias("_g")).select(
        F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.col("check_name")).alias("check_name"), "passed"
    )


def all_passed(checks: dict[str, DataFrame]) -> bool:
    """Driver-side verdict (one boolean)."""
    return bool(pre_checks(checks).where(F.col("check_name") == "all").first()["passed"])
