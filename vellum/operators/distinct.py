"""Whole-row distinct after string normalisation.

Rows that differ only in letter case or outer white space of the normalised
columns fold into one; NULL equals NULL; output order is not kept.
``dropDuplicates`` plans a partial hash aggregate on every input partition
before the shuffle, so a value repeated a billion times crosses the network
once per map task, not once per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from vellum.functions.text import normalise_name


def normalise_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Title case + strip ``columns`` in place; other columns and order kept."""
    return df.withColumns({c: normalise_name(c) for c in columns})


def normalise_distinct(df: DataFrame, columns: list[str]) -> DataFrame:
    return normalise_columns(df, columns).dropDuplicates()
