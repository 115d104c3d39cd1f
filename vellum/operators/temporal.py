"""Joins on time: facts with the periods that are valid at their date, and with the last earlier row.

``interval_join`` matches a fact's instant with closed-open periods ``[start, end)``. Each
period lies on one level, a power of two no less than its length and less than ``2 ** MERGED``
times it, so it meets at most two buckets of that width, however long it is; a fact looks up one
bucket a level. The join is then an equi-join on (key, cell), a cell being a bucket of a
level, with the exact comparison as a residual test: no nested loop, no cartesian product, and a
hot key is spread over its buckets. Only the levels that occur (at most 63
numbers) come to the driver; up to ``MERGED`` neighbours share the highest's buckets, so that a fact moves
once for all of them. Nothing moves that the columns tell again after the join.

``asof_join`` gives each row the last row of the other table before it. Both
tables are laid in one order by range partitioning, so a hot key spreads over many
partitions; the last value is carried inside each partition's slice of a key by a
window, and into the next partitions by one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.session import ensure_checkpoint_dir

_OPEN = (1 << 62) - 1
#: Powers of two in a row that share buckets: a period is compared with the instants of less than twice 2 ** MERGED times its length.
MERGED = 4


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def position(df: DataFrame, name: str) -> Column:
    """A date, timestamp or integer column as a whole number in its own unit."""
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        # From its parts, not through the session's time zone, whose clock may jump.
        of_day = (F.hour(c) * 60 + F.minute(c)).cast("long") * 60_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
        return F.unix_date(F.to_date(c)).cast("long") * 86_400_000_000 + of_day
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    raise TypeError(f"{name} is {kind.simpleString()}: a date, timestamp or integer is needed")


def shared_levels(levels: Sequence[int]) -> dict[int, int]:
    """For every level the one whose buckets it shares: the highest first, with the next ``MERGED - 1`` below it."""
    out: dict[int, int] = {}
    top = None
    for level in sorted(levels, reverse=True):
        if top is None or level <= top - MERGED:
            top = level
        out[level] = top
    return out


def interval_join(
    facts: DataFrame,
    periods: DataFrame,
    key: str | Sequence[str],
    at: str,
    start: str = "fd",
    end: str = "fh",
    how: str = "inner",
) -> DataFrame:
    """Facts with every period of their key that holds ``at``: columns of both, the key once.

    ``how="left"`` keeps facts without a period once, with NULLs. A NULL ``end`` is an open period; a
    NULL ``start``, or an end that is not after it, holds nothing. NULL keys and NULL instants match nothing.
    Overlapping periods all match; repeated rows stay repeated.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how is inner or left, not {how!r}")
    keys = _names(key)
    extra = [c for c in periods.columns if c not in keys]
    if clash := sorted(set(extra) & set(facts.columns)):
        raise ValueError(f"columns of both sides: {clash}")
    first, last = position(periods, start), F.coalesce(position(periods, end), F.lit(_OPEN))
    # The number of binary digits of length - 1: buckets of this power of two are at least as wide as the period.
    level = F.length(F.bin(last - first - 1))
    valid = periods.withColumns({"_s": first, "_e": last}).where("_s IS NOT NULL AND _e > _s").withColumn("_level", level)
    shared = shared_levels([r[0] for r in valid.select("_level").distinct().collect()])
    levels = sorted(set(shared.values()))
    # The lowest level that holds the period: a level between two that occur is none.
    valid = valid.withColumn("_level", F.coalesce(*[F.when(F.col("_level") <= x, F.lit(x)) for x in levels]) if levels else F.lit(0))
    # Shifts by a column's value, so through SQL. A level has less than 7 digits; bits that a shift drops only add pairs to be tested.
    cells = F.expr("transform(sequence(shiftright(_s, _level), shiftright(_e - 1, _level)), b -> shiftleft(b, 6) | _level)")
    cut = valid.withColumn("_cell", F.explode(cells)).drop("_s", "_e", "_level")
    instant = position(facts, at)
    looked_up = F.array(*[F.shiftleft(F.shiftright(instant, x), 6).bitwiseOR(F.lit(x)) for x in levels]) if levels else F.array().cast("array<bigint>")
    points = facts.where(instant.isNotNull()).withColumn("_cell", F.explode(looked_up))
    met = points.join(cut, [*keys, "_cell"]).where((first <= instant) & (instant < last))
    met = met.select(*facts.columns, *extra)
    if how == "inner":
        return met
    # Whether a fact has a period depends on its key and instant alone.
    found = met.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.col(f"`{at}`").alias("_found_at")).distinct()
    same = [F.col(f"`{k}`") == F.col(f"_k{i}") for i, k in enumerate(keys)] + [F.col(f"`{at}`") == F.col("_found_at")]
    alone = facts.join(found, same, "left_anti")
    nulls = [F.lit(None).cast(periods.schema[c].dataType).alias(c) for c in extra]
    return met.unionByName(alone.select(*facts.columns, *nulls))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    left_at: str,
    right_at: str,
    tie: str,
    strict: bool = True,
    within: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Every row of ``left`` with the last row of ``right`` of its key before it (or at it, unless ``strict``).

    Columns of both, the key once; NULLs where no earlier row exists. Of right rows at one
    instant the one with the greatest ``tie`` counts as last. ``within``: the earlier row may be at most so far
    back, in the instants' unit (days of dates, microseconds of timestamps). Rows with a NULL key
    or instant match nothing; repeated left rows stay repeated.

    The union of both sides is exchanged by range of (key, instant) and once more, unmoved but for
    hashing, for the windows; the slice-local result is checkpointed, which freezes the partition ids.
    """
    keys = _names(key)
    extra = [c for c in right.columns if c not in keys]
    if clash := sorted(set(extra) & set(left.columns)):
        raise ValueError(f"columns of both sides: {clash}")
    known = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    earlier, later = (1, 0) if strict else (0, 1)
    key_names = [f"_k{i}" for i in range(len(keys))]
    the_keys = [F.col(f"`{k}`").alias(n) for k, n in zip(keys, key_names, strict=True)]
    kind_l, kind_r = left.select(F.struct("*").alias("s")).schema["s"].dataType, right.select(F.struct(*extra).alias("s")).schema["s"].dataType
    l_rows = left.select(*the_keys, position(left, left_at).alias("_at"), F.lit(later).alias("_side"),
                         F.lit(None).cast(right.schema[tie].dataType).alias("_tie"), F.struct("*").alias("_l"), F.lit(None).cast(kind_r).alias("_r"))
    r_rows = right.where(known).select(*the_keys, position(right, right_at).alias("_at"), F.lit(earlier).alias("_side"),
                                       F.col(f"`{tie}`").alias("_tie"), F.lit(None).cast(kind_l).alias("_l"), F.struct(*extra).alias("_r"))
    order = ["_at", "_side", "_tie"]
    both = l_rows.where(" AND ".join(f"{n} IS NOT NULL" for n in key_names) + " AND _at IS NOT NULL").unionByName(r_rows.where("_at IS NOT NULL"))
    both = both.repartitionByRange(partitions, *key_names, *order) if partitions else both.repartitionByRange(*key_names, *order)
    here = Window.partitionBy("_part", *key_names).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    seen = F.struct(F.col("_at").alias("at"), F.col("_r").alias("row"))
    local = both.withColumn("_part", F.spark_partition_id()).withColumn("_last", F.last(F.when(F.col("_side") == earlier, seen), True).over(here))
    # One row a slice of a key says what was last in it; the others that go on are left rows.
    ensure_checkpoint_dir(local.sparkSession)
    local = local.checkpoint(eager=True)
    slices = local.groupBy("_part", *key_names).agg(F.max_by("_last", F.struct(*order)).alias("_end"))
    before = Window.partitionBy(*key_names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.withColumn("_carried", F.last("_end", True).over(before)).where("_carried IS NOT NULL")
    # Ranges are contiguous: only the first key of a partition can have begun before it, so there is a row a partition at most.
    out = local.where(F.col("_side") == later).join(F.broadcast(carried.select("_part", *key_names, "_carried")), ["_part", *key_names], "left")
    last = F.coalesce("_last", "_carried")
    if within is not None:
        last = F.when(F.col("_at") - last["at"] <= within, last)
    out = out.select("_l", last["row"].alias("_r")).select("_l.*", *[F.col(f"_r.`{c}`").alias(c) for c in extra])
    unknown = left.where(f"NOT ({known})").unionByName(left.where(known).where(F.col(f"`{left_at}`").isNull()))
    nulls = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in extra]
    return out.unionByName(unknown.select(*left.columns, *nulls))
