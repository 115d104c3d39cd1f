"""A bit table of fixed size that tells which rows surely are not among some keys.

It holds one bit per hash value, at most ``WORDS`` words of 64 bits, whatever the
number of keys: the broadcast has a proven bound of ``WORDS`` rows of 16 bytes. A row
whose bit is unset is surely not among the keys; one whose bit is set may be, and is to be checked
by an exact join. So the join moves only rows that may match; where keys outgrow the
bits by far, it moves all, as it would without.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 19


def with_hits(rows: DataFrame, key: Column, keys: DataFrame, keys_key: Column, words: int = WORDS) -> DataFrame:
    """``rows`` with a further column ``_hit``: false where the row's key (a long) is surely not one of the keys'."""
    at = F.pmod(keys_key, F.lit(64 * words))
    bits = (
        keys.select(at.alias("at"))
        .groupBy(F.shiftright("at", 6).alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("_bits"))
    )
    marked = rows.withColumn("_at", F.pmod(key, F.lit(64 * words))).withColumn("_w", F.shiftright("_at", 6))
    joined = marked.join(F.broadcast(bits), F.col("_w") == F.col("_word"), "left")
    hit = F.coalesce(F.expr("_bits & shiftleft(1L, CAST(_at & 63 AS INT))") != 0, F.lit(False))
    return joined.withColumn("_hit", hit).drop("_at", "_w", "_word", "_bits")
