"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A document is the set of its hashed character n-grams (orders 3 to 6, ASCII
lower case, whole text). On a bounded sample of labelled rows the documents
that hold an n-gram are counted per class, over all n-grams; the log ratio of
the smoothed rates is the n-gram's weight as naive Bayes sees it. The
n-grams with the largest ratio evidence become the features, valued by that
ratio where present, and a regularised logistic regression (Spark ML) learns
the linear weights over them. Scoring hashes every n-gram of the whole text
in vectorised slices and looks the weights up in a small table.

The sample: labelled rows outside the held-out third, the first ``SAMPLE``
of them in the order of a hash of the id (a documented, fixed bound). Labels,
language, source and id are never features.

Defined results: a NULL text counts as empty; a text without n-grams gets the
score of the intercept alone; repeated rows get equal scores, row by row; a
NULL id is scored and held out of nothing. Without training rows, or with one
class only, every score is the smoothed rate of the training labels (0.5 if
there are none). Very long texts are hashed in slices that overlap by the
longest order, so memory is bounded and no n-gram is lost. Further columns are
kept as they are, whatever their names; only an older ``score`` is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import checkpointed, held_out, prepare, row_slices, table, utf8_rows
from vellum.llm.quality import ROWS_A_TASK, training_sample

SAMPLE = 20_000
THRESHOLD = 0.7
ORDERS = (3, 4, 5, 6)
BITS = 20
FEATURES = 4096
SLICE = 1 << 17

_MULTIPLIER = np.uint32(0x01000193)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def ngram_hashes(codes: np.ndarray, rows: np.ndarray, order: int, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of one order that do not cross a row's end, and their rows.

    ``codes`` are codepoints (lower-cased), ``rows`` the row number of each.
    """
    n = len(codes) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, rows.dtype)
    h = np.full(n, 0x811C9DC5 + order, np.uint32)
    for k in range(order):
        h = (h ^ codes[k : k + n]) * _MULTIPLIER
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h >>= np.uint32(32 - bits)
    inside = rows[:n] == rows[order - 1 :]
    return h[inside], rows[:n][inside]


def codepoints(flat: np.ndarray) -> np.ndarray:
    """Codepoints of UTF-8 bytes, ASCII letters lower-cased."""
    low = _LOWER[flat]
    return np.frombuffer(low.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def slices(column: pa.Array, limit: int = SLICE, overlap: int = max(ORDERS) - 1) -> Iterator[tuple[int, int, list]]:
    """(first row, end row, [(codepoints, row numbers)]) of the column in slices of about ``limit`` bytes.

    A row longer than that comes alone, in parts that share ``overlap`` codepoints.
    """
    flat, offsets = utf8_rows(column)
    for a, b in row_slices(offsets, limit):
        part = flat[offsets[a] : offsets[b]]
        codes = codepoints(part)
        if b - a == 1:
            rows = np.full(len(codes), a, np.int32)
        else:
            # Codepoints per row: bytes that do not continue a character.
            before = np.append(0, np.cumsum((part & 0xC0) != 0x80))
            rows = np.repeat(np.arange(a, b, dtype=np.int32), np.diff(before[offsets[a : b + 1] - offsets[a]]))
        step = limit if b - a == 1 else max(1, len(codes))
        yield a, b, [(codes[i : i + step + overlap], rows[i : i + step + overlap]) for i in range(0, len(codes), step)]


def distinct_features(column: pa.Array, lookup: np.ndarray | None, orders=ORDERS, bits: int = BITS):
    """Per slice of rows its distinct (row, hashed n-gram) pairs, by row.

    With ``lookup`` only n-grams whose entry is not negative, as entries.
    """
    for _, _, parts in slices(column):
        keys = [np.zeros(0, np.int64)]
        for codes, rows in parts:
            for order in orders:
                h, r = ngram_hashes(codes, rows, order, bits)
                if lookup is not None:
                    at = lookup[h]
                    hit = np.flatnonzero(at >= 0)
                    h, r = at[hit], r[hit]
                keys.append(np.unique(r.astype(np.int64) << 32 | h.astype(np.int64)))
        key = np.unique(np.concatenate(keys))
        yield key >> 32, key & 0xFFFFFFFF


@dataclass
class ToxicityModel:
    """intercept, and for each chosen n-gram its hash and weight (log-count ratio times linear weight)."""

    intercept: float
    hashes: np.ndarray
    weights: np.ndarray
    bits: int = BITS
    orders: tuple[int, ...] = ORDERS

    def lookup(self) -> np.ndarray:
        out = np.full(1 << self.bits, -1, np.int32)
        out[self.hashes] = np.arange(len(self.hashes))
        return out

    def scores(self, column: pa.Array, lookup: np.ndarray) -> np.ndarray:
        total = np.zeros(len(column))
        for rows, at in distinct_features(column, lookup, self.orders, self.bits):
            np.add.at(total, rows, self.weights[at])
        return 1.0 / (1.0 + np.exp(-np.clip(self.intercept + total, -500, 500)))


def _class_counts(bits: int, orders):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << bits), np.int32)
        for b in batches:
            y = np.asarray(b.column("_y").to_numpy(zero_copy_only=False), np.int8)
            for rows, h in distinct_features(b.column("text"), None, orders, bits):
                np.add.at(counts, (y[rows], h), 1)
        for start in range(0, 1 << bits, 1 << 16):
            part = counts[:, start : start + (1 << 16)]
            at = np.flatnonzero(part.any(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array((start + at).astype(np.int32)), pa.array(part[0, at].astype(np.int64)), pa.array(part[1, at].astype(np.int64))],
                names=["h", "n0", "n1"],
            )

    return run


def _vectors(hashes: np.ndarray, ratios: np.ndarray, bits: int, orders):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup = np.full(1 << bits, -1, np.int32)
        lookup[hashes] = np.arange(len(hashes))
        vector = VectorUDT()
        for pdf in batches:
            found = [*distinct_features(pa.array(pdf["text"], pa.string()), lookup, orders, bits)]
            rows, at = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*found, strict=True) if found else ([], [])))
            cut = np.searchsorted(rows, np.arange(len(pdf) + 1))
            held = [at[a:b].astype(np.int32) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pd.DataFrame({"label": pdf["_y"], "features": [vector.serialize(SparseVector(len(hashes), h, ratios[h])) for h in held]})

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    text_col: str = "text",
    id_col: str = "doc_id",
    sample: int = SAMPLE,
    features: int = FEATURES,
    orders: tuple[int, ...] = ORDERS,
    bits: int = BITS,
    smoothing: float = 1.0,
    least_evidence: float = 10.8,
    ridge: float = 0.0005,
) -> ToxicityModel:
    """Learn the classifier from at most ``sample`` labelled rows."""
    prepare(docs.sparkSession)
    rows = checkpointed(training_sample(docs, labels, label, sample, id_col, text_col), sample, ROWS_A_TASK)
    n, positive = rows.agg(F.count("*"), F.sum("_y")).first()
    positive = float(positive or 0.0)
    prior = math.log((positive + 1) / (n - positive + 1))
    nothing = ToxicityModel(prior, np.zeros(0, np.int64), np.zeros(0))
    if not 0 < positive < n:
        return nothing
    n1, n0 = positive + 2 * smoothing, n - positive + 2 * smoothing
    ratio = F.log((F.col("n1") + smoothing) / n1) - F.log((F.col("n0") + smoothing) / n0)
    # Evidence of an n-gram: the likelihood ratio (G) of its presence against the class.
    total, hold = float(n), F.col("n0") + F.col("n1")
    cells = [
        (F.col("n1"), hold * positive / total), (F.col("n0"), hold * (n - positive) / total),
        (positive - F.col("n1"), (total - hold) * positive / total),
        (n - positive - F.col("n0"), (total - hold) * (n - positive) / total),
    ]
    evidence = sum((F.when(o > 0, 2 * o * F.log(o / e)).otherwise(F.lit(0.0)) for o, e in cells), F.lit(0.0))
    chosen = (
        rows.mapInArrow(_class_counts(bits, orders), "h int, n0 long, n1 long")
        .groupBy("h")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .where("n0 + n1 >= 3")
        .withColumn("r", ratio)
        .withColumn("evidence", evidence)
        .where(F.col("evidence") >= least_evidence)
        .orderBy(F.col("evidence").desc(), "h")
        .limit(features)
        .select("h", "r")
        .collect()
    )
    if not chosen:
        return nothing
    hashes, ratios = np.array([x.h for x in chosen], np.int64), np.array([x.r for x in chosen])
    # The vectors are made where the texts are hashed: a second Python step would hold a second worker a core.
    fields = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])
    vectors = checkpointed(rows.mapInPandas(_vectors(hashes, ratios, bits, orders), fields))
    lr = LogisticRegression(maxIter=60, regParam=ridge, elasticNetParam=0.0, standardization=False, tol=1e-5).fit(vectors)
    weights = lr.coefficients.toArray() * ratios
    kept = np.flatnonzero(np.abs(weights) > 1e-6)
    return ToxicityModel(float(lr.intercept), hashes[kept], weights[kept], bits, orders)


def scored(docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Kept columns (all by default, but an older ``score``) and ``score``; a narrow pass over whole texts."""
    prepare(docs.sparkSession)
    names = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    position = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = model.lookup()
        for b in batches:
            score = model.scores(b.column(position), lookup)
            yield pa.RecordBatch.from_arrays([*b.columns[:position], pa.array(score)], names=out_names)

    # Positional names, so that no column of the input can clash with ours.
    plain = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(names)], F.col(text_col).alias("_t"))
    fields = [T.StructField(f"_k{i}", docs.schema[c].dataType) for i, c in enumerate(names)]
    out_names = [f.name for f in fields] + ["_score"]
    out = plain.mapInArrow(run, T.StructType([*fields, T.StructField("_score", T.DoubleType())]))
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(names)], F.col("_score").alias("score"))


def op1_toxicity_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by the classifier learnt from the training part of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = scored(docs, fit(docs, labels), keep=["doc_id"])
    return out.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
