import math
import random

import numpy as np

from llm_brute import components
from pyspark.sql import functions as F

from vellum.llm.embeddings import cells_of, embedding_links, placed_points, sends, spherical_kmeans
from vellum.llm.components import forest


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))


def brute(rows, threshold=0.93):
    def good(v, label):
        return bool(label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v))

    def linked(i, j):
        (_, a, la), (_, b, lb) = rows[i], rows[j]
        return good(a, la) and good(b, lb) and la == lb and len(a) == len(b) and cosine(a, b) >= threshold

    comp = components(rows, linked)
    least = {}
    for (i, *_), c in zip(rows, comp):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    links = [sum(linked(i, j) for j in range(len(rows)) if j != i) for i in range(len(rows))]
    return sorted(((i, n, least.get(c), i is not None and i == least.get(c)) for (i, *_), n, c in zip(rows, links, comp)), key=str)


def near_rows(seed, n=120, dims=12):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [float(np.float32(rng.gauss(0, 1))) for _ in range(dims)]
        rows.append((len(rows), v, i % 3))
        for _ in range(rng.choice([0, 0, 1, 4])):
            w = [float(np.float32(x + rng.gauss(0, rng.choice([0.0, 0.1, 0.25, 0.3])))) for x in v]
            rows.append((len(rows), w, rng.choice([i % 3, i % 3, (i + 1) % 3])))
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int, component_id string, _v int"


def test_against_brute_force_in_many_small_cells_and_blocks(spark):
    rows = near_rows(1)
    rows += [(5000, None, 1), (5001, [0.0] * 12, 1), (5002, [1.0] * 12, None), (5003, [float("nan")] * 12, 1)]
    rows += [(5004, [None] * 12, 1), (5005, [], 1), (5006, [float("inf")] * 12, 1), (None, [1.0] * 12, 2), (5007, [1.0] * 12, 2)]
    rows += [(5008, [1.0] * 5, 2), (17, [-1.0] * 12, 0), (17, [-1.0] * 12, 0), (5009, [-0.0] * 11 + [1.0], 0), (5010, [0.0] * 11 + [2.0], 0)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    got = embedding_links(df, cell_target=20, block=8)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_a_hot_vector_and_an_empty_table(spark):
    rows = [(i, [1.0, 2.0, 3.0], 7) for i in range(500)] + [(600 + i, [1.0, 2.0, 3.0 + i / 50], 7) for i in range(10)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert sorted(map(tuple, embedding_links(df, block=4).collect()), key=str) == brute(rows)
    assert embedding_links(df.limit(0)).count() == 0


def test_a_fit_on_a_sample_loses_no_link(spark):
    rows = near_rows(2, n=80)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert sorted(map(tuple, embedding_links(df, sample=30, cell_target=10, block=16).collect()), key=str) == brute(rows)


def test_visits_reach_every_partner():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 8))
    x = np.concatenate([x, x + rng.normal(scale=0.15, size=x.shape)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    c = spherical_kmeans(x[:200], 24)
    native, visits = cells_of(x, c, math.sqrt(1 - 0.93**2))
    for i, j in zip(*np.nonzero(x @ x.T >= 0.93)):
        assert native[i] == native[j] or visits[i, native[j]]


def test_of_two_cells_one_sends_visitors():
    to = sends(np.arange(9), np.arange(9))
    assert all(to[a, b] != to[b, a] for a in range(9) for b in range(9) if a != b) and not to.diagonal().any()
    assert set(to.sum(1)) == {4}


def test_cells_that_are_split_again_lose_no_link_and_count_none_twice(spark):
    rows = near_rows(3, n=150)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    for most in (2, 5):
        got = embedding_links(df, cell_target=8, most_cells=most, split_above=12, block=7)
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_double_precision_vectors_are_compared_as_they_are(spark):
    rows = near_rows(5, n=40)
    rows = [(i, [x + 1e-12 * i for x in v], label) for i, v, label in rows]
    schema = SCHEMA.replace("array<float>", "array<double>")
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], schema)
    assert sorted(map(tuple, embedding_links(df, cell_target=10, block=16).collect()), key=str) == brute(rows)


def themes(n, dims=64, size=25, seed=8):
    """Vectors of n / size themes: what a table of embeddings looks like that grows by new themes."""
    rng = np.random.default_rng(seed)
    areas = np.repeat(rng.normal(size=(-(-n // (size * 8)), dims)), 8, axis=0)
    centres = areas + 0.45 * rng.normal(size=areas.shape)
    x = np.repeat(centres, size, axis=0)[:n]
    return x + 0.2 * rng.normal(size=x.shape)


def points_frame(spark, x):
    rows = [(1, i, 1, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "_g long, _p long, _m long, _v array<float>").repartition(4)


def sent(spark, x, **options):
    placed = placed_points(points_frame(spark, x), **options)
    cells = placed.groupBy("_cell", "_sub").agg(F.count_if("_native").alias("n"), F.count("*").alias("rows"))
    compared = cells.agg(F.sum(F.col("n") * F.col("rows"))).first()[0]
    assert placed.where("_native").count() == len(x) == placed.where("_native").select("_p").distinct().count()
    return placed.count() / len(x), compared / len(x), cells.agg(F.max("n")).first()[0]


def test_rows_sent_follow_the_input_and_rows_compared_nearly_at_64_dimensions(spark):
    options = {"cell_target": 50, "most_cells": 32, "split_above": 100, "sample": 2000}
    small, large = sent(spark, themes(1600), **options), sent(spark, themes(12800), **options)
    # Of eight times the points each is sent as often; it meets twice as many (eight times, were there no index).
    assert large[0] < 1.5 * small[0] and large[1] < 3 * small[1]
    # With one level of cells they are as many at every size, and larger at a larger one.
    flat = sent(spark, themes(12800), **{**options, "split_above": 10**9})
    assert flat[1] > 2 * large[1] and flat[2] > large[2]


def test_a_dense_clump_is_not_split_again(spark):
    rng = np.random.default_rng(9)
    x = 1.0 + 0.05 * rng.normal(size=(900, 64))
    once = sent(spark, x, cell_target=100, most_cells=2, split_above=10**9, sample=400)
    assert sent(spark, x, cell_target=100, most_cells=2, split_above=150, sample=400) == once


def test_forest_connects_what_the_links_connect():
    rng = np.random.default_rng(6)
    links = rng.random((30, 40)) < 0.04
    a, b = forest(links, np.arange(30), 100 + np.arange(40))
    assert all(links[x, y - 100] for x, y in zip(a, b)) and len(a) < 70

    def groups(edges):
        parent = {i: i for i in [*range(30), *range(100, 140)]}
        for x, y in edges:
            roots = []
            for v in (x, y):
                while parent[v] != v:
                    v = parent[v]
                roots.append(v)
            parent[max(roots)] = min(roots)
        out = []
        for v in parent:
            while parent[v] != v:
                v = parent[v]
            out.append(v)
        return out

    assert groups(zip(a, b)) == groups((x, 100 + y) for x, y in zip(*np.nonzero(links)))
