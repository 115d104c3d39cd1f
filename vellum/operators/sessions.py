"""Sessions and sliding windows over an event log.

``sessions`` merges events of a key that lie no more than a gap apart with ``session_window``, an
aggregation that is partial before its shuffle. Sessions longer than a bound are split
into parts of that length by an interval join, so that the parts of one endless session are
counted in many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.operators.temporal import interval_join, position


def sessions(log: DataFrame, key: str, ts: str, gap_seconds: int, longest_seconds: int | None = None, flag: Column | None = None) -> DataFrame:
    """key, session_start, part (from 0), started, ended, events, flagged of every session, or part of one.

    An event no more than the gap after another belongs to its session. ``flagged`` counts the events where
    ``flag`` holds. Events with a NULL key are a key's; those without a time are in no session. Parts without events are none.
    """
    flag = F.lit(False) if flag is None else F.coalesce(flag, F.lit(False))
    rows = log.where(F.col(f"`{ts}`").isNotNull()).select(F.col(f"`{key}`").alias("k"), F.col(f"`{ts}`").alias("t"), flag.alias("f"))
    counts = [F.min("t").alias("started"), F.max("t").alias("ended"), F.count("*").alias("events"), F.count_if("f").alias("flagged")]
    whole = rows.groupBy("k", F.session_window("t", f"{gap_seconds} seconds")).agg(*counts)
    whole = whole.select("k", F.col("started").alias("session_start"), F.lit(0).cast("long").alias("part"), "started", "ended", "events", "flagged")
    names = [F.col("k").alias(key), "session_start", "part", "started", "ended", "events", "flagged"]
    if longest_seconds is None:
        return whole.select(*names)
    begin, end = position(whole, "started"), position(whole, "ended")
    long = end - begin >= longest_seconds * 1_000_000
    # A NULL key joins nothing; as a struct it is a value.
    step = longest_seconds * 1_000_000
    parts = whole.where(long).select(F.struct("k").alias("kk"), "session_start", begin.alias("s"), end.alias("e"))
    parts = parts.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("e") - F.col("s")) / step))))
    parts = parts.select("kk", "session_start", "part", (F.col("s") + F.col("part") * step).alias("from"), F.least(F.col("s") + (F.col("part") + 1) * step, F.col("e") + 1).alias("to"))
    at = rows.select(F.struct("k").alias("kk"), "t", "f", position(rows, "t").alias("us"))
    split = interval_join(at, parts, "kk", "us", "from", "to").groupBy("kk", "session_start", "part").agg(*counts)
    split = split.select(F.col("kk.k").alias("k"), "session_start", "part", "started", "ended", "events", "flagged")
    return whole.where(~long).unionByName(split).select(*names)


def sliding_counts(log: DataFrame, ts: str, by: str, length: str, slide: str) -> DataFrame:
    """window_start, window_end, by, events: events a value of ``by`` in every window of that length, each slide."""
    counted = log.groupBy(F.window(ts, length, slide).alias("w"), F.col(by)).agg(F.count("*").alias("events"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), by, "events")
