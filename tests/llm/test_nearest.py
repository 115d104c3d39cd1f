import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.llm import nearest as nn

SCHEMA = "vec_id long, embedding array<double>, score string, _v int, _row long"


def brute(rows, k, every):
    usable = {
        (i, tuple(x + 0.0 for x in v))
        for i, v in rows
        if i is not None and v and not any(x is None or not math.isfinite(x) for x in v) and any(v)
    }
    out = []
    for qi, q in usable:
        if qi % every == 0:
            scored = []
            for i, w in usable:
                if i != qi and len(w) == len(q):
                    s = 0.0
                    for a, b in zip(q, w):
                        s += a * b
                    scored.append((-s, i))
            out += [(qi, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def found(spark, rows, k, every, **how):
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], SCHEMA).repartition(5)
    got = nn.nearest(df, F.col("vec_id") % every == 0, k=k, **how)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


def test_against_brute_force_with_odd_vectors_ties_and_repeats(spark):
    rng = np.random.default_rng(3)
    rows = [(i, list(map(float, rng.normal(size=9)))) for i in range(300)]
    rows += [(300 + i, list(rows[5][1])) for i in range(60)]  # more copies than k + 1
    rows += [(400 + i, [x + 1e-9 * i for x in rows[5][1]]) for i in range(40)]  # nearer than the codes can tell
    rows += [(20, rows[7][1]), (20, rows[7][1]), (7, rows[7][1]), (7, rows[8][1]), (5, rows[5][1])]
    rows += [(600, None), (620, [None] * 9), (640, [float("nan")] * 9), (660, [float("inf")] + [0.0] * 8), (None, [1.0] * 9)]
    rows += [(680, []), (700, [0.0] * 9), (720, [1e-320] * 9), (740, [1e300] * 9), (760, [-0.0] * 8 + [1.0]), (780, [1.0, 2.0]), (801, [3.0, 2.0])]
    want = brute(rows, 6, 20)
    assert found(spark, rows, 6, 20) == want
    assert found(spark, rows, 6, 20, candidate_block=(16, 64), query_block=4) == want


def test_hot_vectors_are_cut_by_a_shuffle_too(spark, monkeypatch):
    rows = [(i, [float(i % 3), 1.0]) for i in range(120)]
    want = brute(rows, 4, 10)
    monkeypatch.setattr(nn, "BROADCAST_ROWS", 0)
    assert found(spark, rows, 4, 10, candidate_block=(16, 16)) == want


def test_copies_beyond_the_reach_of_any_query_stay_out_of_the_blocks(spark):
    rows = spark.range(0, 5000).select(F.col("id").alias("_id"), F.lit(1).alias("_h1"), F.lit(2).alias("_h2"))
    assert sorted(r._id for r in nn._without_far_copies(rows, 20).collect()) == list(range(21))


def test_fewer_rows_than_asked_for_and_an_empty_table(spark):
    assert found(spark, [(0, [1.0]), (1, [2.0])], 20, 20) == [(0, 1, 1, 2.0)]
    assert found(spark, [(0, [1.0])], 20, 20) == []
    assert found(spark, [(1, [1.0]), (2, [1.0])], 20, 20) == []
    df = spark.createDataFrame([], SCHEMA)
    assert nn.nearest(df, F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("width", [3, 64, 1500])
def test_bounds_hold_and_few_pairs_survive(width):
    rng = np.random.default_rng(width)
    q, x = rng.normal(size=(50, width)) * 10.0 ** rng.integers(-3, 4, (50, 1)), rng.normal(size=(2000, width))
    a, b = nn.Codes(q), nn.Codes(x)
    assert (nn.int_products(a.q, b.q) == a.q.astype(np.int64) @ b.q.astype(np.int64).T).all()
    near, off = nn.bounds(a, b, slice(0, 50), slice(0, 2000))
    true = q @ x.T
    assert (np.abs(true - near) <= off).all()
    kth = np.partition(near - off, 1980, axis=1)[:, 1980]
    # The bound widens with the number of components: random vectors of 1,500 are its worst case.
    assert (near + off >= kth[:, None]).mean() < (0.05 if width <= 64 else 0.2)


def test_heaps_hold_the_best(spark):
    rng = np.random.default_rng(9)
    q, x = rng.normal(size=(30, 8)), rng.normal(size=(500, 8))
    heaps = nn.search_block(np.arange(30), q, np.arange(500), x, np.zeros(500, np.int64), 7, (8, 64))
    for i, heap in enumerate(heaps):
        score = nn.exact(np.repeat(q[i : i + 1], 500, 0), x)
        order = [j for j in np.lexsort((np.arange(500), -score)).tolist() if j != i][:7]
        assert [-v for _, v, _ in sorted(heap, reverse=True)] == order
