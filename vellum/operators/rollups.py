"""Aggregates that can be added up further: grouping sets, distinct counts, quantiles.

``grouping_sets`` (and ``rollup``, ``cube``) aggregate once to the finest keys and expand only
that result into the sets: the fact is not multiplied by their number. Averages
travel as sum and count. ``distinct_sketches`` stores one HLL sketch a group;
``merged_distinct`` unites any of them without another scan of the fact.
``exact_quantiles`` selects order statistics by range partitioning and rank offsets,
so no group's values are gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.session import ensure_checkpoint_dir

#: What each aggregate is made of at the finest keys, and how the parts are merged.
_MERGED = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], aggregates: dict[str, tuple[str, str]]) -> DataFrame:
    """One row a group of each set: the keys (NULL where they are rolled up), ``grouping_id``, the aggregates.

    ``aggregates``: name -> (count / sum / min / max / avg, column; ``*`` counts rows). ``grouping_id`` has a bit per key, the first
    key's highest, set where the key is rolled up; so a NULL key value differs from a rolled-up one. Sets that
    repeat give their groups once. An empty table gives no rows, no grand total either.
    """
    keys = list(dict.fromkeys(k for s in sets for k in s))
    wanted = list(dict.fromkeys(tuple(k for k in keys if k in s) for s in sets))
    parts: dict[str, Column] = {}
    finals: dict[str, Column] = {}
    for name, (how, column) in aggregates.items():
        source = F.lit(1) if column == "*" else F.col(f"`{column}`")
        if how == "avg":
            parts |= {f"_{name}_s": F.sum(source), f"_{name}_n": F.count(source)}
            finals[name] = F.sum(f"_{name}_s") / F.sum(f"_{name}_n")
        elif how in _MERGED:
            parts[f"_{name}"] = getattr(F, how)(source)
            merged = getattr(F, _MERGED[how])(f"_{name}")
            finals[name] = F.coalesce(merged, F.lit(0)) if how == "count" else merged
        else:
            raise ValueError(f"aggregate {how!r} cannot be merged")
    finest = df.groupBy(*keys).agg(*[c.alias(n) for n, c in parts.items()])
    if not keys:
        return finest.agg(*[c.alias(n) for n, c in finals.items()]).select(F.lit(0).cast("long").alias("grouping_id"), *finals)
    out = finest.groupingSets([[F.col(k) for k in s] for s in wanted], *keys)
    out = out.agg(F.grouping_id().cast("long").alias("grouping_id"), *[c.alias(n) for n, c in finals.items()])
    return out.select(*keys, "grouping_id", *finals)


def rollup(df: DataFrame, keys: Sequence[str], aggregates: dict[str, tuple[str, str]]) -> DataFrame:
    """Grouping sets of every prefix of the keys."""
    return grouping_sets(df, [keys[:n] for n in range(len(keys), -1, -1)], aggregates)


def cube(df: DataFrame, keys: Sequence[str], aggregates: dict[str, tuple[str, str]]) -> DataFrame:
    """Grouping sets of every subset of the keys."""
    return grouping_sets(df, [s for n in range(len(keys), -1, -1) for s in combinations(keys, n)], aggregates)


def distinct_sketches(df: DataFrame, keys: Sequence[str], column: str, lg_k: int = 12) -> DataFrame:
    """Keys and ``sketch``: an HLL sketch of the column's distinct values, to be stored and merged."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(f"`{column}`"), F.lit(lg_k)).alias("sketch"))


def merged_distinct(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys and ``estimate``: distinct values over all sketches of a key."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(False))).alias("estimate"))


def hll_error(lg_k: int = 12, deviations: float = 3.0) -> float:
    """The relative error that a merged sketch stays within, at so many standard deviations."""
    return deviations * 1.04 / (2**lg_k) ** 0.5


def exact_quantiles(df: DataFrame, key: str, value: str, shares: Sequence[float], partitions: int | None = None) -> DataFrame:
    """Per key: ``n`` and one column ``p<percent>`` a share, interpolated between the two neighbouring values.

    NULL and NaN values are left out; a key with none of its own is left out too; a NULL key is a group. Rows
    are range-partitioned by (key, value), so a hot key spreads over partitions; a row's rank is its place in the
    partition's slice of the key plus the counts of earlier slices, a row per partition and key.
    """
    rows = df.select(F.col(f"`{key}`").alias("_k"), F.col(f"`{value}`").cast("double").alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)")
    # Equal values are one row with a number: what is sorted is no larger than the distinct values.
    rows = rows.groupBy("_k", "_v").agg(F.count("*").alias("_m"))
    rows = rows.repartitionByRange(partitions, "_k", "_v") if partitions else rows.repartitionByRange("_k", "_v")
    here = Window.partitionBy("_part", "_k").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_part", F.spark_partition_id()).withColumn("_upto", F.sum("_m").over(here))
    ensure_checkpoint_dir(local.sparkSession)
    local = local.checkpoint(eager=True)
    slices = local.groupBy("_k", "_part").agg(F.sum("_m").alias("_s"))
    of_key = Window.partitionBy("_k")
    before = of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("_k", "_part", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"), F.sum("_s").over(of_key).alias("n"))
    same = F.col("a._k").eqNullSafe(F.col("b._k")) & (F.col("a._part") == F.col("b._part"))
    placed = local.alias("a").join(slices.alias("b"), same).select("a._k", "_v", "n", (F.col("_upto") + F.col("_before")).alias("_hi"), "_m")
    # Ranks from 0: a row covers _hi - _m .. _hi - 1.
    columns, picks = [], []
    for share in shares:
        if not 0 <= share <= 1:
            raise ValueError(f"a share is between 0 and 1, not {share}")
        at = F.lit(float(share)) * (F.col("n") - 1)
        low, high = F.floor(at), F.ceil(at)
        covers = [(F.col("_hi") - F.col("_m") <= rank) & (rank < F.col("_hi")) for rank in (low, high)]
        name = f"p{round(share * 1000) / 10:g}".replace(".", "_")
        picks += [F.max(F.when(c, F.col("_v"))).alias(f"_{name}_{i}") for i, c in enumerate(covers)]
        part = F.lit(float(share)) * (F.col("n") - 1) - F.floor(F.lit(float(share)) * (F.col("n") - 1))
        columns.append((F.col(f"_{name}_0") + (F.col(f"_{name}_1") - F.col(f"_{name}_0")) * part).alias(name))
    return placed.groupBy("_k", "n").agg(*picks).select(F.col("_k").alias(key), F.col("n").cast("long").alias("n"), *columns)
