"""Left-join chains and the flat (denormalised) fact.

Plain joins without hints: nothing runs while a plan is built, and each side
is read once. Adaptive execution turns a join into a broadcast when the real
shuffle size of a side turns out small, and splits skewed partitions of the
others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def left_chain(base: DataFrame, steps: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """``base ⟕ s1 ⟕ s2 …``; each step is (right frame, left key, right key).

    Fans out when a left key matches several right rows; the right columns are
    NULL when nothing matches. Keys are compared with ``=`` (NULL keys never
    match), so a NULL key keeps its left row with NULL right columns.
    """
    out = base
    for right, left_key, right_key in steps:
        out = out.join(right, out[left_key] == right[right_key], "left")
    return out


def flat_fact(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """``fact ⟕ dim`` on a shared key name, one key column in the result."""
    return fact.join(dim, on=key, how="left")
