"""History of a table from its loads: validity periods, and the difference of two loads.

``scd2`` turns successive full snapshots into closed-open periods ``[fd, fh)`` of equal
rows: a version ends at the first snapshot that shows the key otherwise or not at all; the
last one is open (``fh`` NULL). ``with_late_snapshot`` puts a snapshot that
arrived late into an existing history: its span is cut out of every period, its
rows fill the span, and touching periods of equal rows grow together again.

``snapshot_diff`` compares two loads as multisets by signed counts: one aggregation of
their union, no anti joins. What nets out leaves before the rows of a key meet, so a
hot key brings only its differences together.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FD, FH = "fd", "fh"


def _listed(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def grown_together(periods: DataFrame, key: str | Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Periods of a key, free of overlap, with touching ones of equal attributes made one.

    A window per key: its rows are the key's versions, of which one key has at most one a snapshot.
    """
    keys, attributes = _listed(key), list(attributes)
    row = F.struct(*attributes) if attributes else F.lit(0)
    in_order = Window.partitionBy(*keys).orderBy(FD)
    starts = ~(F.lag(FH).over(in_order).eqNullSafe(F.col(FD)) & F.lag(row).over(in_order).eqNullSafe(row))
    numbered = periods.withColumn("_starts", starts.cast("int"))
    numbered = numbered.withColumn("_version", F.sum("_starts").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    # An open period is the last of its version.
    last = F.max_by(FH, FD).alias(FH)
    return numbered.groupBy(*keys, "_version", *attributes).agg(F.min(FD).alias(FD), last).select(*keys, *attributes, FD, FH)


def _one_a_key(rows: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """One row a key (and instant): equal rows are one; of different ones the smallest counts."""
    return rows.groupBy(*keys).agg(F.min(F.struct(*attributes)).alias("_row")).select(*keys, "_row.*")


def scd2(snapshots: DataFrame, key: str | Sequence[str], at: str, attributes: Sequence[str]) -> DataFrame:
    """Key, attributes, fd, fh of every version that the snapshots show.

    A snapshot is all rows of one ``at`` (a date); the order of arrival does not matter. Rows
    with a NULL key or ``at`` are no versions. A row that a snapshot repeats counts once; of different rows
    of a key in one snapshot the smallest counts. NULL attributes are values like others.
    """
    keys, attributes = _listed(key), list(attributes)
    rows = snapshots.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, at]))
    rows = _one_a_key(rows.withColumnRenamed(at, FD), [*keys, FD], attributes)
    # A row a snapshot; its window is as small as the calendar.
    dates = snapshots.where(F.col(f"`{at}`").isNotNull()).select(F.col(f"`{at}`").alias(FD)).distinct()
    dates = dates.withColumn(FH, F.lead(FD).over(Window.orderBy(FD)))
    return grown_together(rows.join(dates, FD), keys, attributes)


def with_late_snapshot(
    history: DataFrame, snapshot: DataFrame, key: str | Sequence[str], attributes: Sequence[str], at: date, until: date | None
) -> DataFrame:
    """The history as if the snapshot of ``at`` had been there, where ``until`` is the next known snapshot (None: it is the newest)."""
    keys, attributes = _listed(key), list(attributes)
    begin, end = F.lit(at), F.lit(until).cast("date")
    before = F.when(F.col(FD) < begin, F.struct(F.col(FD).alias("s"), F.least(F.col(FH), begin).alias("e")))
    goes_on = (F.col(FH).isNull() | (F.col(FH) > end)) & end.isNotNull()
    after = F.when(goes_on, F.struct(F.greatest(F.col(FD), end).alias("s"), F.col(FH).alias("e")))
    kept = history.withColumn("_part", F.explode(F.array_compact(F.array(before, after))))
    kept = kept.select(*keys, *attributes, F.col("_part.s").alias(FD), F.col("_part.e").alias(FH))
    known = snapshot.where(" AND ".join(f"`{c}` IS NOT NULL" for c in keys))
    fresh = _one_a_key(known, keys, attributes).select(*keys, *attributes, begin.alias(FD), end.alias(FH))
    return grown_together(kept.unionByName(fresh), keys, attributes)


INSERTED, DELETED, CHANGED, RECOUNTED = "inserted", "deleted", "changed", "recounted"


def snapshot_diff(before: DataFrame, after: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """How ``after`` differs from ``before``: key, kind, n_before, n_after, changed_columns, and after's columns.

    ``recounted``: a row of both loads, in another number. ``changed``: a key whose only differences are
    one row gone and one come; ``changed_columns`` names, in order, where they differ. All other rows
    of one side are ``inserted`` or ``deleted`` with their numbers. NULLs are equal to NULLs, in keys as well.
    Column types must be comparable and equal on both sides.
    """
    keys = _listed(key)
    if before.dtypes != after.dtypes:
        raise ValueError("both loads need the same columns and types")
    others = [c for c in before.columns if c not in keys]
    sides = [df.withColumns({"_b": F.lit(b), "_a": F.lit(a)}) for df, b, a in ((before, 1, 0), (after, 0, 1))]
    counted = sides[0].unionByName(sides[1]).groupBy(*keys, *others).agg(F.sum("_b").alias("n_before"), F.sum("_a").alias("n_after"))
    differing = counted.where("n_before <> n_after")
    gone, come = F.col("n_after") == 0, F.col("n_before") == 0
    of_key = Window.partitionBy(*keys)
    old = F.max(F.when(gone, F.struct(*others))).over(of_key) if others else F.lit(None)
    alone = (F.count("*").over(of_key) == 2) & (F.sum(F.when(gone, F.col("n_before"))).over(of_key) == 1) & (F.sum(F.when(come, F.col("n_after"))).over(of_key) == 1)
    marked = differing.withColumns({"_pair": F.coalesce(alone, F.lit(False)), "_old": old, "_gone": gone, "_come": come})
    # Of a changed key the row that came stands for both.
    marked = marked.where("NOT (_pair AND _gone)")
    names = [F.when(F.col("_pair") & ~F.col(f"`{c}`").eqNullSafe(F.col(f"_old.`{c}`")), F.lit(c)) for c in others]
    kind = F.when(F.col("_pair"), CHANGED).when(F.col("_gone"), DELETED).when(F.col("_come"), INSERTED).otherwise(RECOUNTED)
    return marked.select(
        *keys, kind.alias("kind"), F.when(F.col("_pair"), 1).otherwise(F.col("n_before")).cast("long").alias("n_before"), "n_after",
        F.concat_ws(",", *names).alias("changed_columns") if names else F.lit("").alias("changed_columns"), *others,
    )
