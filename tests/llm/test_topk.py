import math

from pyspark.sql import functions as F

from vellum.llm.topk import exact_top_k

SCHEMA = "vec_id long, embedding array<float>, score string, _w int"


def brute(rows, k):
    usable = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, [math.floor(1024 * x) for x in v]))
    out = []
    for qi, q in usable:
        if qi % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, w)), i) for i, w in usable if i != qi))[:k]
        out += [(qi, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def test_against_brute_force_with_odd_vectors_ties_and_repeats(spark):
    rows = [(i, [((i * 7 + d * 3) % 11 - 5) / 8 for d in range(6)]) for i in range(0, 400)]
    rows += [(500, None), (501, [None] * 6), (600, [float("nan")] * 6), (700, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    rows += [(800, []), (900, [0.0] * 6), (900, [1.0] * 6), (7, [0.5] * 6), (1000, [0.25, 0.5])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(5)
    got = exact_top_k(df, F.col("vec_id") % 100 == 0, k=10, candidate_block=(16, 64), query_block=2)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    as_floats = [(i, None if v is None else v) for i, v in rows]
    assert sorted(map(tuple, got.collect())) == brute(as_floats, 10)


def test_fewer_rows_than_asked_for_and_an_empty_table(spark):
    df = spark.createDataFrame([(0, [1.0], "", 0), (1, [2.0], "", 0)], SCHEMA)
    assert [tuple(r) for r in exact_top_k(df, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]
    assert exact_top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
