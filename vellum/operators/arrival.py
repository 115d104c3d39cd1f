"""Semi-structured arrival: JSON text as VARIANT columns against a contract of typed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.contracts import spark_type


def variant_arrival(df: DataFrame, json_col: str, contract: dict[str, str]) -> DataFrame:
    """The other columns, the contract's fields, and what does not fit kept beside them.

    ``_variant`` is the row's value; ``_unfit`` names, in the contract's order, the fields that are there but not of their type (their column
    is NULL, their value stays in ``_variant``); ``_missing`` those that are absent or JSON null; ``_extra``, sorted,
    the top-level fields that the contract does not have; ``_malformed`` holds text that is no JSON object. A NULL text has
    all fields missing. Of a field that an object repeats none can be told: such text is malformed.
    """
    text = F.col(f"`{json_col}`")
    value = F.try_parse_json(text)
    rows = df.select(*[F.col(f"`{c}`") for c in df.columns if c != json_col], text.alias("_text"), value.alias("_variant"))
    keys = F.json_object_keys("_text")
    # Spark's parser stops after the first value. What follows it would break one of these two, or be a second element.
    alone = (F.json_array_length(F.concat(F.lit("["), "_text", F.lit("]"))) == 1) & F.json_object_keys(F.concat(F.lit('{"x":'), "_text", F.lit("}"))).isNotNull()
    is_object = F.coalesce(F.col("_variant").isNotNull() & F.schema_of_variant("_variant").startswith("OBJECT") & alone, F.lit(False))
    rows = rows.withColumn("_variant", F.when(is_object, F.col("_variant")))
    fields, unfit, missing = [], [], []
    for name, kind in contract.items():
        path = f"$['{name}']"
        typed = F.try_variant_get("_variant", path, spark_type(kind).simpleString())
        there = F.try_variant_get("_variant", path, "variant")
        there = there.isNotNull() & ~F.coalesce(F.is_variant_null(there), F.lit(False))
        fields.append(typed.alias(name))
        unfit.append(F.when(there & typed.isNull(), F.lit(name)))
        missing.append(F.when(~there, F.lit(name)))
    extra = F.array_except(F.coalesce(keys, F.array().cast("array<string>")), F.array(*[F.lit(n) for n in contract]))
    extra = F.when(F.col("_variant").isNotNull(), F.array_join(F.array_sort(extra), ",")).otherwise("")
    kept = [F.col(f"`{c}`") for c in df.columns if c != json_col and c not in contract]
    return rows.select(
        *kept, *fields, F.concat_ws(",", *unfit).alias("_unfit"), F.concat_ws(",", *missing).alias("_missing"), extra.alias("_extra"),
        F.when(F.col("_variant").isNull(), F.col("_text")).alias("_malformed"), "_variant",
    )


def arrival_report(arrived: DataFrame, contract: dict[str, str]) -> DataFrame:
    """One row a contract field: how many rows have it, lack it, or hold it in another type; then the malformed rows."""
    total = [F.count_if(F.find_in_set(F.lit(n), c) > 0).alias(f"{c}{i}") for i, n in enumerate(contract) for c in ("_unfit", "_missing")]
    counts = arrived.agg(F.count("*").alias("rows"), F.count("_malformed").alias("bad"), *total)
    each = [
        F.struct(F.lit(n).alias("field"), (F.col("rows") - F.col(f"_unfit{i}") - F.col(f"_missing{i}")).alias("fit"), F.col(f"_unfit{i}").alias("unfit"), F.col(f"_missing{i}").alias("missing"))
        for i, n in enumerate(contract)
    ]
    return counts.select(F.explode(F.array(*each)).alias("f"), "bad").select("f.*", F.col("bad").alias("malformed_rows"))


def arrival_schema(arrived: DataFrame) -> DataFrame:
    """One row: the schema that all variants share, fields merged to their common types."""
    return arrived.agg(F.schema_of_variant_agg("_variant").alias("schema"))
