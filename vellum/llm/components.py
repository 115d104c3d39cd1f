"""Connected components of an edge table by alternating large and small stars.

Each round re-hangs every node's larger neighbours on its smallest neighbour
(large star), then its smaller ones (small star). The table stays in Spark
throughout; only two numbers a round, to see that nothing changed, reach the
driver. Each round's table is checkpointed, so lost executors cost no rounds; its
estimated size goes no further, as a product of all joins before it has no bound.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import checkpointed, without_estimate


def forest(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (left id, right id) that connect what a boolean link matrix connects, at most one fewer than its points."""
    a_done, b_done = np.zeros(len(left), bool), np.zeros(len(right), bool)
    src, dst = [], []
    for start in range(len(left)):
        if a_done[start]:
            continue
        a_done[start] = True
        wave = np.array([start])
        while len(wave):
            reach = links[wave].any(0) & ~b_done
            new_b = np.flatnonzero(reach)
            if not len(new_b):
                break
            via = wave[links[np.ix_(wave, new_b)].argmax(0)]
            src.append(left[via])
            dst.append(right[new_b])
            b_done[new_b] = True
            back = links[:, new_b].any(1) & ~a_done
            wave = np.flatnonzero(back)
            src.append(left[wave])
            dst.append(right[new_b[links[np.ix_(wave, new_b)].argmax(1)]])
            a_done[wave] = True
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *src]), np.concatenate([empty, *dst])


def _smallest(edges: DataFrame, rows: int) -> DataFrame:
    """(u, m): the smallest neighbour of u, written once so that a hub's rows can be split in the join."""
    return without_estimate(checkpointed(edges.groupBy("u").agg(F.min("v").alias("m")), rows))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    NULL ends and loops are ignored; repeated edges count once; no edges give no rows.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = without_estimate(checkpointed(e))
    state = _state(e)
    while state[0]:
        rows = 2 * state[0]
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = _smallest(both, rows)
        hung = both.join(m, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        e = without_estimate(checkpointed(hung.distinct(), rows))
        m = _smallest(e, rows)
        hung = e.join(m, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = without_estimate(checkpointed(hung.unionByName(m.select("u", F.col("m").alias("v"))).distinct(), rows))
        before, state = state, _state(e)
        if state == before:
            break
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
