"""Contract checks (minimum schema, value domains, typed arrival).

The schema check reads only ``df.schema``: no Spark job runs. It follows the
warehouse's rules: every contract column must be present (case-sensitive),
with exactly the mapped type (no widening), extra columns and column order do
not matter, nullability is not checked, and every violation is reported in
one error. A contract of ``None`` disables the check.

Value-domain checks (the unsigned ranges) are one aggregation over the table,
partial on every partition, so their cost is one scan and a tiny shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.contracts import spark_type, to_struct, value_range
from vellum.functions.casts import guarded_try_cast


@dataclass(frozen=True)
class Gap:
    """One way in which a schema falls short of a contract; ``found`` is None for an absent column."""

    column: str
    declared: str
    wanted: str
    found: str | None

    def __str__(self) -> str:
        state = "is absent" if self.found is None else f"is {self.found}"
        return f"{self.column} {state}, wanted {self.wanted} (declared {self.declared})"


class ContractError(ValueError):
    """A frame falls short of its contract; ``gaps`` says how."""

    def __init__(self, where: str, gaps: list[Gap]):
        self.where, self.gaps = where, list(gaps)
        super().__init__(f"{where}: {len(self.gaps)} contract gap(s): " + "; ".join(map(str, self.gaps)))


def contract_gaps(schema: T.StructType, contract: dict[str, str] | None) -> list[Gap]:
    """What the contract's struct has and the schema has not, as (name, type) pairs, in contract order."""
    if not contract:
        return []
    have = dict(schema_types(schema))
    wanted = schema_types(to_struct(contract))
    lacking = set(wanted) - set(have.items())
    return [Gap(n, contract[n], t, have.get(n)) for n, t in wanted if (n, t) in lacking]


def schema_types(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def require_contract(df: DataFrame, contract: dict[str, str] | None, where: str) -> DataFrame:
    """``df`` itself, or ``ContractError`` with every gap at once."""
    if gaps := contract_gaps(df.schema, contract):
        raise ContractError(where, gaps)
    return df


def enforce(contract: dict[str, str] | None, where: str) -> Callable[[DataFrame], DataFrame]:
    """``require_contract`` as a step for ``DataFrame.transform``."""
    return lambda df: require_contract(df, contract, where)


def contract_report(
    spark: SparkSession, df: DataFrame, contract: dict[str, str], with_counts: bool = False
) -> DataFrame:
    """One row per contract column: (column_name, expected, found, ok).

    The type part comes from the schema alone. ``with_counts`` adds, from one
    aggregation over the whole frame, ``non_null`` and ``out_of_domain`` per
    present column (NULL for absent columns).
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    for name, type_name in contract.items():
        expected = spark_type(type_name).simpleString()
        found = actual[name].simpleString() if name in actual else None
        rows.append((name, expected, found, found == expected))
    schema = "column_name string, expected string, found string, ok boolean"
    report = spark.createDataFrame(rows, schema)
    if not with_counts:
        return report
    present = [n for n in contract if n in actual]
    if not present:
        return report.withColumn("non_null", F.lit(None).cast("bigint")).withColumn(
            "out_of_domain", F.lit(None).cast("bigint")
        )
    aggs = []
    for i, name in enumerate(present):
        rng = value_range(contract[name])
        bad = _domain_predicate(F.col(name), *rng) if rng else F.lit(False)
        aggs.append(F.count(F.col(name)).alias(f"n{i}"))
        aggs.append(F.count_if(bad).cast("bigint").alias(f"v{i}"))
    one = df.agg(*aggs)
    # Unpivot the single row into one row per present column.
    stack_args = ", ".join(f"'{name}', n{i}, v{i}" for i, name in enumerate(present))
    counts = one.selectExpr(f"stack({len(present)}, {stack_args}) as (column_name, non_null, out_of_domain)")
    # counts has one row per declared column: a bounded broadcast.
    return report.join(F.broadcast(counts), "column_name", "left").select(
        "column_name", "expected", "found", "ok", "non_null", "out_of_domain"
    )


def _domain_predicate(c: Column, lo: int, hi: int) -> Column:
    # NULL never violates: the comparison is NULL and count_if skips it.
    return (c < F.lit(lo)) | (c > F.lit(hi))


def domain_columns(df: DataFrame, contract: dict[str, str]) -> dict[str, tuple[int, int]]:
    present = set(df.columns)
    out = {}
    for name, type_name in contract.items():
        rng = value_range(type_name)
        if rng is not None and name in present:
            out[name] = rng
    return out


def domain_violations(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """One row: ``<column>_violations`` per ranged column, plus ``rows``.

    One aggregation over the whole table (partial aggregates per partition).
    """
    cols = domain_columns(df, contract)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for name, (lo, hi) in cols.items():
        aggs.append(
            F.count_if(_domain_predicate(F.col(name), lo, hi)).cast("bigint").alias(f"{name}_violations")
        )
    return df.agg(*aggs)


def violation_flag(df: DataFrame, contract: dict[str, str]) -> Column:
    """True where any ranged column of the row is out of its domain."""
    cols = domain_columns(df, contract)
    flag = F.lit(False)
    for name, (lo, hi) in cols.items():
        flag = flag | F.coalesce(_domain_predicate(F.col(name), lo, hi), F.lit(False))
    return flag


def split_by_domain(df: DataFrame, contract: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows within every domain, rows with at least one violation)."""
    flag = violation_flag(df, contract)
    return df.where(~flag), df.where(flag)


def cast_to_contract(df: DataFrame, contract: dict[str, str], keep_extra: bool = False) -> DataFrame:
    """``try_cast`` each contract column to its mapped type.

    Adds ``_cast_failures``: how many columns of the row had a non-NULL raw
    value that did not survive the cast (what a typed database client would
    have refused). Missing contract columns raise ``ContractError``.
    """
    missing = [c for c in contract if c not in df.columns]
    if missing:
        raise ContractError("cast_to_contract", [Gap(c, contract[c], spark_type(contract[c]).simpleString(), None) for c in missing])
    casts = []
    failures = []
    for name, type_name in contract.items():
        target = spark_type(type_name)
        raw = F.col(name)
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        cast = guarded_try_cast(raw, target) if is_text else raw.try_cast(target)
        casts.append(cast.alias(name))
        failures.append(F.when(raw.isNotNull() & cast.isNull(), 1).otherwise(0))
    extra = [F.col(c) for c in df.columns if c not in contract] if keep_extra else []
    total = failures[0]
    for f in failures[1:]:
        total = total + f
    return df.select(*casts, *extra, total.alias("_cast_failures"))
