"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors become integer postings (``floor(scale * x)``). The query rows and the
candidate rows are dealt into blocks; every (query block, candidate block)
pair is one task unit. Inside a unit the candidates are turned into postings
lists per dimension ("term"); a query walks its non-zero terms and scatters
``query weight * posting weight`` into a dense score array of the block; a
partition selection keeps the k best of the block. The blocks' lists are then
merged by a ranked window, whose limit Spark applies before the shuffle too.

Defined results: vectors that are NULL, or hold a NULL or non-finite
component, take no part, neither as query nor as candidate. An empty vector
takes part with score 0. Missing trailing components count as 0. Ties go to
the smaller id; rows that repeat an id are queries and candidates of their own,
but never match a query of the same id; rows with a NULL id take no part. An empty table gives
no rows. Other columns are ignored. Sums are 64-bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import checkpointed, prepare, session_partitions

#: Rows of a block: candidates are cut so that every task has some, within these bounds; a query block
#: is as large as a task can hold, since candidates are sent once for each.
CANDIDATE_BLOCK = (2048, 32_768)
QUERY_BLOCK = 8192


def integer_weights(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component, x as double; NULL unless all components are finite."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return F.when(vector.isNotNull() & finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def postings(weights: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per term, the rows that hold it and their weights there."""
    width = max((len(w) for w in weights), default=0)
    dense = np.zeros((len(weights), width), np.int64)
    for i, w in enumerate(weights):
        dense[i, : len(w)] = w
    out = []
    for t in range(width):
        rows = np.flatnonzero(dense[:, t])
        out.append((rows, dense[rows, t]))
    return out


def accumulate(query: np.ndarray, lists: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """Scores of all ``n`` rows of a block for one query, a term at a time."""
    scores = np.zeros(n, np.int64)
    for t in np.flatnonzero(query[: len(lists)]):
        rows, weights = lists[t]
        scores[rows] += query[t] * weights
    return scores


def select(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= edge)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]


def _search_block(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, ...]] = []
        if len(queries) and len(rows):
            ids = rows["_id"].to_numpy(np.int64)
            lists = postings(list(rows["_w"]))
            for qid, row, w in zip(queries["_id"], queries["_row"], queries["_w"], strict=True):
                scores = accumulate(np.asarray(w, np.int64), lists, len(ids))
                other = np.flatnonzero(ids != qid)
                best = other[select(scores[other], ids[other], k)]
                found.append((np.full(len(best), qid), np.full(len(best), row), ids[best], scores[best]))
        cat = [np.concatenate([np.zeros(0, np.int64), *(f[i] for f in found)]).astype(np.int64) for i in range(4)]
        return pd.DataFrame({"query_id": cat[0], "_row": cat[1], "vec_id": cat[2], "score": cat[3]})

    return run


def exact_top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    candidate_block: tuple[int, int] = CANDIDATE_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k best other rows of each query row by integer inner product.

    Returns query_id, rank (from 1), vec_id, score.
    """
    spark = df.sparkSession
    prepare(spark)
    rows = df.select(
        F.col(id_col).cast("long").alias("_id"),
        integer_weights(F.col(vector_col), scale).alias("_w"),
        F.coalesce(is_query, F.lit(False)).alias("_q"),
        F.monotonically_increasing_id().alias("_row"),
    ).where("_id IS NOT NULL AND _w IS NOT NULL")
    rows = checkpointed(rows)
    counts = rows.agg(F.count("*"), F.count_if("_q")).first()
    block = min(max(-(-counts[0] // session_partitions(spark)), candidate_block[0]), candidate_block[1])
    n_cand = max(1, -(-counts[0] // block))
    n_query = max(1, -(-counts[1] // query_block))
    # Every pair of blocks is one group: the query set against all rows, in blocks.
    cand = rows.select("_id", "_w", F.pmod(F.xxhash64("_id"), F.lit(n_cand)).cast("int").alias("_cb"))
    cand = cand.withColumn("_qb", F.explode(F.sequence(F.lit(0), F.lit(n_query - 1))))
    query = rows.where("_q").select("_id", "_row", "_w", F.pmod(F.xxhash64("_id"), F.lit(n_query)).cast("int").alias("_qb"))
    query = query.withColumn("_cb", F.explode(F.sequence(F.lit(0), F.lit(n_cand - 1))))
    width = max(session_partitions(spark), min(n_cand * n_query, 20_000))
    best = (
        query.repartition(width, "_qb", "_cb")
        .groupBy("_qb", "_cb")
        .cogroup(cand.repartition(width, "_qb", "_cb").groupBy("_qb", "_cb"))
        .applyInPandas(_search_block(k), "query_id long, _row long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id", "_row").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op8_exact_topk(spark, sf_dir: str) -> DataFrame:
    """The ten best of all rows for every vector whose id is divisible by 100."""
    from vellum.llm.common import table

    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
