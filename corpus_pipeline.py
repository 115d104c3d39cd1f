"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor
kept; ``run`` writes every stage's result as Parquet in the shared folder and
reads it back for the next one. All stages but the last return the columns of
their input. Model stages learn from the labels of the documents that reached
them, outside the held-out third.

Defined results: a NULL or empty text is scored like an empty text, is never
a duplicate, holds no values, and is packed as one end id. Repeated rows are
scored alike, and one of them stays as of any group of copies. An empty table
gives an empty result at every stage. Further columns pass through; their
names may clash with any name used inside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm import minhash, packing, pii, quality, toxicity
from vellum.llm.common import prepare, table
from vellum.session import shared_dir

QUALITY_AT_LEAST = quality.THRESHOLD
TOXIC_FROM = toxicity.THRESHOLD


#: Inside a stage the columns are called _c0, _c1, ..., so that no name of the input can clash with one used there.


def _named(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject (score of 0.5 or more)."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    return _named(quality.accepted(plain, model, f"_c{docs.columns.index('text')}", QUALITY_AT_LEAST), docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the n-gram classifier does not call toxic (score below 0.7)."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    rows = toxicity.scored(plain, model, f"_c{docs.columns.index('text')}")
    return _named(rows.where(F.col("score") < TOXIC_FROM), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that 5-word shingles link at 0.8 or more."""
    prepare(spark)
    return minhash.one_of_each(docs, shingle=5, percent=80)


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their values pseudonymised; n_chars follows the text."""
    prepare(spark)
    out = pii.pseudonymise(docs, pii.DEMO_KEY, spans_col=None)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces packed into sequences of at most 2048 ids."""
    import public_tokenizers

    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("pii", replace_pii),
    ("packing", pack),
]

#: Learnt models, keyed permutations and genetic packing are no SQL; tests/llm holds the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
