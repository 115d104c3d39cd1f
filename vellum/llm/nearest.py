"""Nearest neighbours by inner product: a block matrix join over int8 codes with error bounds.

Vectors become int8 codes and one scale each. Query rows and candidate rows are
dealt into blocks; every (query block, candidate block) is one task unit, worked
off in tiles. The tile's product of codes is exact in integers; with the scales it gives
each inner product up to an error that Cauchy-Schwarz bounds by the norms of what
rounding left out: ``|x.y - x'.y'| <= |x - x'| |y| + |x'| |y - y'|``. A pair survives a tile
if its upper bound reaches both the tile's k-th best lower bound and the k-th best score the
query has so far. Survivors are recomputed in double precision from the vectors
themselves, a component at a time in order, and merged into a heap of k per query. Blocks
hand on at most k rows per query; a ranked window, limited before the shuffle
too, merges them. Nothing is lost, so the answer is exact.

Of candidates with equal vectors only those with the k + 1 smallest ids can be among
anybody's k nearest (ties go to the smaller id, and a query leaves out one id). So beyond
that id the copies of a vector, however many there are, stay out of the tiles.

Defined results: vectors that are NULL, empty, zero, or hold NULL or
non-finite components, and rows with a NULL id, take no part. Vectors of different
lengths are no candidates for each other. Ties go to the smaller id. Rows that repeat an
id and its vector count once, as query and as candidate; rows that repeat an id with
other vectors are queries and candidates of their own, but never of each other. Fewer candidates
than k are all returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm.common import checkpointed, prepare, session_partitions, table
from vellum.llm.embeddings import usable

#: Rows of a block: candidates are cut so that every task has some, within these bounds; candidates are sent once
#: per query block.
CANDIDATE_BLOCK = (2048, 32_768)
QUERY_BLOCK = 8192
#: Rows of a tile: queries, candidates.
TILE = 256, 4096
#: The table of hot vectors is broadcast up to so many rows of 24 bytes.
BROADCAST_ROWS = 100_000
#: Products of int8 codes stay exact in single precision over so many components.
EXACT_COMPONENTS = 1024


class Codes:
    """int8 codes of rows, their scales, and the norms that bound what a product of codes can be off."""

    def __init__(self, x: np.ndarray):
        top = np.abs(x).max(1)
        # A scale that underflows to nothing would make no codes: then all codes are 0 and the error is the vector.
        self.scale = top / 127.0
        safe = np.where(self.scale > 0, self.scale, 1.0)
        self.q = np.clip(np.rint(x / safe[:, None]), -127, 127).astype(np.int8)
        near = self.q * self.scale[:, None]
        self.lost = self._norm(x - near)
        self.norm = self._norm(x)
        self.near_norm = self._norm(near)

    @staticmethod
    def _norm(x: np.ndarray) -> np.ndarray:
        # Scaled, so that squares neither overflow nor vanish; a little more than the norm, as it is a bound.
        top = np.abs(x).max(1)
        safe = np.where(top > 0, top, 1.0)
        return np.sqrt(((x / safe[:, None]) ** 2).sum(1)) * top * (1 + 1e-9)


def int_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of int8 rows, in double precision."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_COMPONENTS):
        out += a[:, at : at + EXACT_COMPONENTS].astype(np.float32) @ b[:, at : at + EXACT_COMPONENTS].astype(np.float32).T
    return out


def bounds(queries: Codes, rows: Codes, i: slice, j: slice) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of the codes in their scales, and how far the true ones can be off."""
    near = int_products(queries.q[i], rows.q[j]) * queries.scale[i][:, None] * rows.scale[j][None, :]
    off = np.outer(queries.lost[i], rows.norm[j]) + np.outer(queries.near_norm[i], rows.lost[j])
    # What rounding adds to these sums and to the score itself is below this.
    rounding = 1e-12 + 4e-16 * queries.q.shape[1]
    return near, off * (1 + 1e-9) + rounding * np.outer(queries.norm[i], rows.norm[j]) + 1e-300


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, added up component by component."""
    out = np.zeros(len(x))
    for d in range(x.shape[1]):
        out += x[:, d] * y[:, d]
    return out


def search_block(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, prints: np.ndarray, k: int, tile: tuple[int, int] = TILE) -> list[list]:
    """Per query its k nearest rows of the block as a heap of (score, -id, fingerprint of the vector)."""
    heaps: list[list[tuple[float, int, int]]] = [[] for _ in q_ids]
    codes_q, codes_x = Codes(q), Codes(x)
    least = np.full(len(q), -np.inf)
    for j in range(0, len(x), tile[1]):
        there = slice(j, j + tile[1])
        for i in range(0, len(q), tile[0]):
            here = slice(i, i + tile[0])
            near, off = bounds(codes_q, codes_x, here, there)
            own = q_ids[here][:, None] == ids[there][None, :]
            low = near - off
            low[own | ~np.isfinite(low)] = -np.inf
            threshold = least[here]
            if low.shape[1] > k:
                threshold = np.maximum(threshold, np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k])
            # Bounds that overflow say nothing: such a pair survives.
            a, b = np.nonzero(~(near + off < threshold[:, None]) & ~own)
            for at in range(0, len(a), 1 << 14):
                r, c = a[at : at + (1 << 14)] + i, b[at : at + (1 << 14)] + j
                for query, score, vec, one in zip(r.tolist(), exact(q[r], x[c]).tolist(), (-ids[c]).tolist(), prints[c].tolist(), strict=True):
                    heap = heaps[query]
                    if math.isnan(score):
                        continue
                    if len(heap) < k:
                        heapq.heappush(heap, (score, vec, one))
                    elif (score, vec, one) > heap[0]:
                        heapq.heapreplace(heap, (score, vec, one))
            for query in np.unique(a) + i:
                if len(heaps[query]) == k:
                    least[query] = heaps[query][0][0]
    return heaps


def _matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in vectors])


def _search(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int, float]] = []
        if len(queries) and len(rows):
            q_ids, ids, q, x = queries["_id"].to_numpy(np.int64), rows["_id"].to_numpy(np.int64), _matrix(queries["_v"]), _matrix(rows["_v"])
            # A row that repeats another's id and vector is one candidate.
            _, one = np.unique(np.column_stack([ids.view(np.uint64), (x + 0.0).view(np.uint64)]), axis=0, return_index=True)
            one.sort()
            heaps = search_block(q_ids, q, ids[one], x[one], rows["_h1"].to_numpy(np.int64)[one], k)
            for qid, row, heap in zip(q_ids.tolist(), queries["_row"].tolist(), heaps, strict=True):
                found += [(qid, row, -vec, copy, score) for score, vec, copy in heap]
        kinds = {"query_id": "int64", "_row": "int64", "vec_id": "int64", "_copy": "int64", "score": "float64"}
        return pd.DataFrame(found, columns=list(kinds)).astype(kinds)

    return run


def _without_far_copies(rows: DataFrame, k: int) -> DataFrame:
    """Rows whose id is among the k + 1 smallest of their vector; only vectors with more ids are looked at."""
    ids = rows.select("_h1", "_h2", "_id").distinct()
    counted = ids.groupBy("_h1", "_h2").agg(F.count("*").alias("n")).where(F.col("n") > k + 1).select("_h1", "_h2")
    hot = checkpointed(counted)
    n = hot.count()
    if not n:
        return rows
    hot = F.broadcast(hot) if n <= BROADCAST_ROWS else hot
    smallest = Window.partitionBy("_h1", "_h2").orderBy("_id")
    last = ids.join(hot, ["_h1", "_h2"]).withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k + 1)
    last = checkpointed(last.groupBy("_h1", "_h2").agg(F.max("_id").alias("_last")))
    joined = rows.join(F.broadcast(last) if n <= BROADCAST_ROWS else last, ["_h1", "_h2"], "left")
    return joined.where("_last IS NULL OR _id <= _last").drop("_last")


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    candidate_block: tuple[int, int] = CANDIDATE_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k other rows of largest inner product with each query row: query_id, rank (from 1), vec_id, score."""
    spark = df.sparkSession
    prepare(spark)
    rows = df.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).alias("_v"), F.coalesce(is_query, F.lit(False)).alias("_q"))
    rows = rows.where(F.col("_id").isNotNull() & usable(F.col("_v")))
    # Vectors are compared as they are, with -0.0 as 0.0. The vector comes last: a column's hash is the next one's seed,
    # so only different seeds before it make two hashes independent.
    zeroed = F.transform("_v", lambda x: x.cast("double") + F.lit(0.0))
    rows = rows.withColumns({"_h1": F.xxhash64(zeroed), "_h2": F.xxhash64(F.lit(7), zeroed), "_d": F.size("_v")})
    rows = checkpointed(rows.withColumn("_row", F.monotonically_increasing_id()))
    sizes = rows.groupBy("_d").agg(F.count("*").alias("_n"), F.count_if("_q").alias("_nq"))
    aim = max(-(-rows.count() // session_partitions(spark)), candidate_block[0])
    aim = min(aim, candidate_block[1])
    # A group is a vector length; it has as many blocks as its rows need.
    sizes = checkpointed(sizes.where("_nq > 0").select("_d", F.ceil(F.col("_n") / aim).cast("int").alias("_cbs"), F.ceil(F.col("_nq") / query_block).cast("int").alias("_qbs")))
    cand = _without_far_copies(rows, k).join(sizes, "_d")
    cand = cand.withColumn("_cb", F.pmod(F.xxhash64("_row"), F.col("_cbs")).cast("int")).withColumn("_qb", F.explode(F.sequence(F.lit(0), F.col("_qbs") - 1)))
    one = rows.where("_q").dropDuplicates(["_id", "_h1", "_h2"]).join(sizes, "_d")
    query = one.withColumn("_qb", F.pmod(F.xxhash64("_row"), F.col("_qbs")).cast("int")).withColumn("_cb", F.explode(F.sequence(F.lit(0), F.col("_cbs") - 1)))
    unit = ["_d", "_qb", "_cb"]
    units = sizes.agg(F.sum(F.col("_cbs").cast("long") * F.col("_qbs"))).first()[0] or 1
    width = max(session_partitions(spark), min(units, 20_000))
    best = (
        query.select(*unit, "_id", "_row", "_v").toDF(*unit, "_id", "_row", "_v").repartition(width, *unit).groupBy(*unit)
        .cogroup(cand.select(*unit, "_id", "_h1", "_v").repartition(width, *unit).groupBy(*unit))
        .applyInPandas(_search(k), "query_id long, _row long, vec_id long, _copy long, score double")
    )
    # Rows that repeat an id and a vector may lie in several blocks: they share a place, and one of them is taken.
    per_query = Window.partitionBy("query_id", "_row")
    place = F.dense_rank().over(per_query.orderBy(F.col("score").desc(), F.col("vec_id"), F.col("_copy")))
    best = best.withColumn("place", place).where(F.col("place") <= k).dropDuplicates(["query_id", "_row", "place"])
    return best.select("query_id", F.col("place").alias("rank"), "vec_id", "score")


def op11_block_matrix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest of all rows for every vector whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_reduce(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2]), lambda a, b: a + b) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.w) = len(c.w)
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
