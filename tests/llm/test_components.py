import random

from pyspark.sql import functions as F

from vellum.llm.components import connected_components


def union_find(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_chain_hub_repeats_loops_and_nulls(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(1000, 1080)] + [(5, i) for i in range(2000, 2400)]
    edges += [(rng.randrange(3000, 3300), rng.randrange(3000, 3300)) for _ in range(200)]
    edges += edges[:50] + [(b, a) for a, b in edges[:50]] + [(7, 7), (None, 8), (9, None)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == union_find(edges)


def test_no_edges(spark):
    df = spark.createDataFrame([], "a long, b long")
    assert connected_components(df).count() == 0


def test_the_estimated_size_does_not_grow_with_the_rounds(spark):
    """A join's estimated bytes are the product of its sides'; carried from round to round the number filled the driver."""
    df = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    estimate = lambda t: int(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    comp = connected_components(df)
    assert estimate(comp) < 2**80
    more = spark.createDataFrame([(40, 50), (50, 51)], "a long, b long")
    comp = connected_components(comp.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    assert estimate(comp) < 2**80
    assert {r.node: r.component for r in comp.collect()} == {i: 0 for i in [*range(41), 50, 51]}
