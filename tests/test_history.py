"""Time joins, histories, mergeable aggregates, arrival, sessions and readiness: odd frames, empty tables, plans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from vellum.operators import arrival, history, readiness, rollups, sessions, temporal
from vellum.plans import history_queries as H

SF = "/root/testdata/sf0.001"
D = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture()
def plan(capsys):
    def _plan(df) -> str:
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return _plan


@pytest.fixture()
def without_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# --- interval join


def test_interval_join_against_brute_force(spark):
    rng = random.Random(2)
    facts = [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, *range(-50, 400)])) for i in range(300)]
    facts += facts[:5]
    periods = []
    for i in range(80):
        s = rng.choice([None, *range(-60, 380)])
        length = rng.choice([None, 0, -3, 1, 2, 3, 4, 5, 17, 64, 65, 1000])
        periods.append((rng.choice([1, 2, None]), i, None if s is None else s, None if s is None or length is None else s + length))
    periods += periods[:4]
    f = spark.createDataFrame(facts, "id int, k int, at int")
    p = spark.createDataFrame(periods, "k int, p int, fd int, fh int")
    for days in (False, True):
        if days:
            f = f.withColumn("at", F.date_add(F.lit(dt.date(1970, 1, 1)), F.col("at")))
            p = p.withColumns({c: F.date_add(F.lit(dt.date(1970, 1, 1)), F.col(c)) for c in ("fd", "fh")})
        want, alone = [], []
        for i, k, at in facts:
            hit = [q for q in periods if k is not None and k == q[0] and at is not None and q[2] is not None and q[2] <= at and (q[3] is None or at < q[3])]
            want += [(i, q[1]) for q in hit]
            alone += [] if hit else [(i, None)]
        assert rows(temporal.interval_join(f, p, "k", "at").select("id", "p")) == sorted(want, key=str)
        assert rows(temporal.interval_join(f, p, "k", "at", how="left").select("id", "p")) == sorted(want + alone, key=str)
    assert temporal.interval_join(f.limit(0), p, "k", "at").count() == 0
    assert temporal.interval_join(f, p.limit(0), "k", "at").count() == 0
    assert temporal.interval_join(f, p.limit(0), "k", "at", how="left").count() == len(facts)
    with pytest.raises(ValueError):
        temporal.interval_join(f, p.withColumn("id", F.lit(1)), "k", "at")
    with pytest.raises(TypeError):
        temporal.interval_join(f.withColumn("at", F.lit("x")), p, "k", "at")


def test_interval_join_on_timestamps_of_both_kinds(spark):
    f = spark.sql("SELECT 1 AS k, timestamp_ntz'2020-03-29 02:30:00' AS at, timestamp'2020-03-29 02:30:00' AS at2")
    p = spark.sql("SELECT 1 AS k, timestamp_ntz'2020-03-29 02:00:00' AS fd, timestamp_ntz'2020-03-29 03:00:00' AS fh")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert temporal.interval_join(f, p, "k", "at").count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    q = p.withColumns({c: F.col(c).cast("timestamp") for c in ("fd", "fh")})
    assert temporal.interval_join(f, q, "k", "at2").count() == 1


def test_interval_join_has_no_nested_loop(spark, plan, without_broadcast):
    for key in ("interval_join", "interval_join_left"):
        text = plan(E.queries()[key](spark, SF))
        assert "NestedLoop" not in text and "Cartesian" not in text and "SortMergeJoin" in text


def test_interval_join_looks_a_fact_up_once_for_neighbouring_lengths(spark, plan, without_broadcast):
    """Lengths from 1 to 64 lie on seven powers of two: a fact moves for two of them (before: for all seven)."""
    for levels in ([], [3], [0, 1, 5, 9, 62], list(range(63))):
        shared = temporal.shared_levels(levels)
        assert sorted(shared) == levels and all(0 <= top - x < temporal.MERGED and top in levels for x, top in shared.items())
    assert len(set(temporal.shared_levels(range(63)).values())) == 16
    p = spark.range(1, 65).selectExpr("id % 2 AS k", "id AS p", "100 - id AS fd", "100 AS fh")
    f = spark.range(200).selectExpr("id AS f", "id % 2 AS k", "id AS at")
    met = temporal.interval_join(f, p, "k", "at")
    text = plan(met)
    assert text.count("shiftleft(shiftright(") // text.count("explode(array(") == 2
    assert rows(met.select("f", "p")) == sorted(((a, b) for a in range(200) for b in range(1, 65) if a % 2 == b % 2 and 100 - b <= a < 100), key=str)


def test_interval_join_on_numbers_near_the_ends_of_long(spark):
    ends = [-(1 << 62), -(1 << 61) - 1, -65, -64, -1, 0, 1, 63, 1 << 40, (1 << 61) + 3, (1 << 62) - 2]
    rng = random.Random(9)
    f = [(i, x + d) for i, (x, d) in enumerate((x, d) for x in ends[1:-1] for d in (-1, 0, 1))]
    p = [(i, s, s + n) for i, (s, n) in enumerate((x + rng.randrange(-3, 3), n) for x in ends[1:-1] for n in (1, 2, 7, 8, 9, 100, 1 << 45, 1 << 60)) if s + n < 1 << 62]
    want = sorted(((a, b) for a, at in f for b, s, e in p if s <= at < e), key=str)
    facts = spark.createDataFrame(f, "f int, at long").withColumn("k", F.lit(1))
    periods = spark.createDataFrame(p, "p int, fd long, fh long").withColumn("k", F.lit(1))
    assert rows(temporal.interval_join(facts, periods, "k", "at").select("f", "p")) == want


# --- as-of join


@pytest.mark.parametrize("strict,within", [(True, None), (False, None), (False, 30)])
def test_asof_join_against_brute_force(spark, strict, within):
    rng = random.Random(5)
    left = [(i, rng.choice([1, 1, 1, 1, 2, 3, None]), rng.choice([None, *range(200)])) for i in range(400)] + [(0, 1, 5)] * 2
    right = [(rng.choice([1, 1, 2, None]), rng.choice([None, *range(0, 200, 3)]), i, rng.choice(["a", None])) for i in range(150)]
    want = []
    for i, k, at in left:
        best = max(((r[1], r[2], r[3]) for r in right if None not in (k, at, r[1]) and r[0] == k and (r[1] < at or (not strict and r[1] == at))), default=None, key=lambda b: b[:2])
        if best and within is not None and at - best[0] > within:
            best = None
        want.append((k, i, at, *(best or (None, None, None))))
    a = spark.createDataFrame([(k, i, at) for i, k, at in left], "k int, id int, at int")
    b = spark.createDataFrame(right, "k int, rat int, n int, _l string")
    for partitions in (None, 7):
        got = temporal.asof_join(a, b, "k", "at", "rat", tie="n", strict=strict, within=within, partitions=partitions)
        assert rows(got) == sorted(want, key=str)
    assert temporal.asof_join(a.limit(0), b, "k", "at", "rat", tie="n").count() == 0
    assert temporal.asof_join(a, b.limit(0), "k", "at", "rat", tie="n").where("rat IS NULL").count() == len(left)


def test_asof_join_spreads_a_hot_key(spark, plan, monkeypatch):
    sizes = []
    keep = type(spark.range(1)).checkpoint

    def watched(df, eager=True):
        out = keep(df, eager)
        sizes.append([r["count"] for r in out.groupBy("_part").count().collect()])
        return out

    left = spark.range(20_000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)).alias("k"), F.col("id").alias("at"))
    right = left.select("k", F.col("at").alias("rat"), F.col("at").alias("n"))
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", watched)
    out = temporal.asof_join(left, right, "k", "at", "rat", tie="n", partitions=8)
    # A third of all rows has one key; no partition holds much more than its share.
    assert len(sizes[0]) == 8 and max(sizes[0]) < 1.5 * sum(sizes[0]) / 8
    text = plan(out)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "Cartesian" not in text
    assert out.where("rat >= at").count() == 0 and out.count() == 20_000


# --- SCD type 2


def fold(shots, skip=()):
    """Versions by a walk over the snapshots."""
    dates = sorted({s for s, *_ in shots if s is not None})
    by = {}
    for s, k, *v in shots:
        if s is not None and k is not None:
            old = by.get((k, s))
            key = tuple((x is not None, x) for x in v)
            if old is None or key < old[0]:
                by[k, s] = key, tuple(v)
    out = []
    for k in {k for k, _ in by}:
        current = None
        for i, s in enumerate(dates):
            v = by.get((k, s), (None, None))[1]
            if current and (v is None or v != current[1]):
                out.append((k, *current[1], current[0], s))
                current = None
            if v is not None and current is None:
                current = (s, v)
        if current:
            out.append((k, *current[1], current[0], None))
    return sorted(out, key=str)


def snapshots():
    rng = random.Random(3)
    out = []
    for i in range(9):
        for k in range(25):
            if rng.random() < 0.8:
                out.append((D(30 * i), k, rng.choice(["a", "b", None]), rng.choice([1, None])))
    return out + out[:20] + [(D(60), 3, "zz", 2), (None, 3, "a", 1), (D(30), None, "a", 1)]


def test_scd2_and_a_late_snapshot_wherever_it_falls(spark):
    shots, schema = snapshots(), "at date, k int, a string, b int"
    df = spark.createDataFrame(shots, schema).repartition(3)
    whole = history.scd2(df, "k", "at", ["a", "b"])
    assert whole.columns == ["k", "a", "b", "fd", "fh"] and rows(whole) == fold(shots)
    for i in (0, 4, 8):
        others = df.where(F.col("at").isNull() | (F.col("at") != D(30 * i)))
        merged = history.with_late_snapshot(
            history.scd2(others, "k", "at", ["a", "b"]), df.where(F.col("at") == D(30 * i)).drop("at"), "k", ["a", "b"], D(30 * i), D(30 * (i + 1)) if i < 8 else None
        )
        assert rows(merged) == fold(shots)
    # Neither overlaps nor touching periods of equal rows.
    byk = {}
    for k, a, b, fd, fh in rows(whole):
        byk.setdefault(k, []).append((fd, fh, a, b))
    for v in byk.values():
        v.sort(key=lambda x: x[0])
        assert all(x[1] is not None and x[1] <= y[0] and (x[1] < y[0] or x[2:] != y[2:]) for x, y in zip(v, v[1:]))
    assert history.scd2(df.limit(0), "k", "at", ["a", "b"]).count() == 0


# --- snapshot difference


def test_snapshot_diff_as_multisets(spark, plan, without_broadcast):
    before = [(1, "a", 1), (2, "b", None), (3, "c", 1), (3, "c", 1), (4, "d", 1), (None, "n", 1), (5, "e", 1), (5, "f", 1), (6, None, None)]
    after = [(1, "a", 1), (2, "b", 7), (3, "c", 1), (7, "g", 1), (7, "g", 1), (None, "m", 2), (5, "x", 1), (6, None, None), (6, None, None)]
    schema = "k int, s string, n int"
    a, b = spark.createDataFrame(before, schema), spark.createDataFrame(after, schema)
    out = history.snapshot_diff(a, b, "k")
    assert rows(out) == sorted([
        (2, "changed", 1, 1, "n", "b", 7), (3, "recounted", 2, 1, "", "c", 1), (4, "deleted", 1, 0, "", "d", 1), (7, "inserted", 0, 2, "", "g", 1),
        (None, "changed", 1, 1, "s,n", "m", 2), (5, "deleted", 1, 0, "", "e", 1), (5, "deleted", 1, 0, "", "f", 1), (5, "inserted", 0, 1, "", "x", 1),
        (6, "recounted", 1, 2, "", None, None),
    ], key=str)
    assert history.snapshot_diff(a, a, "k").count() == 0
    assert history.snapshot_diff(a.limit(0), a.limit(0), "k").count() == 0
    assert {r.kind for r in history.snapshot_diff(a.limit(0), b, "k").collect()} == {"inserted"}
    text = plan(history.snapshot_diff(a, b, "k"))
    assert "Join" not in text and text.count("hashpartitioning") == 2
    with pytest.raises(ValueError):
        history.snapshot_diff(a, b.withColumn("n", F.lit("x")), "k")


# --- grouping sets, sketches, quantiles


def test_cube_over_nulls_ties_and_an_empty_table(spark, plan):
    data = [(1, "a", 5), (1, None, 5), (None, "a", 2), (None, None, None), (1, "a", 5)]
    df = spark.createDataFrame(data, "x int, y string, v int")
    aggs = {"n": ("count", "*"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "m": ("avg", "v"), "c": ("count", "y")}
    want = []
    for gid, keep in enumerate([(True, True), (True, False), (False, True), (False, False)]):
        groups = {}
        for x, y, v in data:
            groups.setdefault((x if keep[0] else None, y if keep[1] else None), []).append((y, v))
        for g, vs in groups.items():
            v = [q for _, q in vs if q is not None]
            want.append((*g, gid, len(vs), sum(v) if v else None, min(v, default=None), max(v, default=None), sum(v) / len(v) if v else None, sum(y is not None for y, _ in vs)))
    assert rows(rollups.cube(df, ["x", "y"], aggs)) == sorted(want, key=str)
    assert rows(rollups.rollup(df, ["x", "y"], aggs)) == sorted((w for w in want if w[2] != 2), key=str)
    assert rows(rollups.grouping_sets(df, [["y"], ["y"]], aggs)) == sorted(((w[1], 0, *w[3:]) for w in want if w[2] == 2), key=str)
    assert [r.n for r in rollups.grouping_sets(df, [[]], aggs).collect()] == [5]
    assert rollups.cube(df.limit(0), ["x"], aggs).count() == 0
    with pytest.raises(ValueError):
        rollups.cube(df, ["x"], {"m": ("median", "v")})


def test_the_fact_is_aggregated_before_it_is_expanded(spark, plan):
    for key in ("premiums_cube", "premiums_rollup", "premiums_grouping_sets"):
        tree = plan(E.queries()[key](spark, SF)).split("\n\n")[0]
        expand = tree.index("Expand")
        # Further down the tree: both halves of the finest aggregation, and an exchange between them.
        below = tree[expand:]
        assert below.count("HashAggregate") == 2 and below.count("Exchange") == 1


def test_sketches_merge_without_the_fact(spark, plan, workdir):
    facts = spark.range(40_000).select((F.col("id") % 12).alias("month"), (F.col("id") % 9_000).alias("who")).unionByName(spark.sql("SELECT 1L, CAST(NULL AS BIGINT)").toDF("month", "who"))
    path = workdir("hll")
    rollups.distinct_sketches(facts, ["month"], "who").write.parquet(path)
    stored = spark.read.parquet(path).withColumn("span", F.when(F.col("month") < 6, "h1").otherwise("h2"))
    exact = {r[0]: r[1] for r in facts.groupBy(F.when(F.col("month") < 6, "h1").otherwise("h2")).agg(F.countDistinct("who")).collect()}
    merged = rollups.merged_distinct(stored, ["span"])
    for r in merged.collect():
        assert abs(r.estimate - exact[r.span]) <= rollups.hll_error() * exact[r.span]
    text = plan(merged)
    assert "Range" not in text and "Scan parquet" in text
    assert rollups.merged_distinct(rollups.distinct_sketches(facts.limit(0), ["month"], "who"), ["month"]).count() == 0


def test_quantiles_with_ties_nulls_and_a_hot_key(spark, plan):
    import duckdb
    import pandas as pd

    rng = random.Random(6)
    data = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, float("nan"), 1.0, 1.0, rng.random() * 100])) for _ in range(3000)] + [("one", 3.5), ("none", None)]
    df = spark.createDataFrame(data, "k string, v double").repartition(4)
    t = pd.DataFrame([(k, v) for k, v in data if v is not None and v == v], columns=["k", "v"])  # noqa: F841
    want = duckdb.sql("SELECT k, count(*), quantile_cont(v, 0), quantile_cont(v, 0.5), quantile_cont(v, 0.999), quantile_cont(v, 1) FROM t GROUP BY k").fetchall()
    for partitions in (None, 7):
        out = rollups.exact_quantiles(df, "k", "v", [0, 0.5, 0.999, 1], partitions)
        assert out.columns == ["k", "n", "p0", "p50", "p99_9", "p100"]
        got = rows(out)
        assert [g[:2] for g in got] == [w[:2] for w in sorted(want, key=str)]
        for g, w in zip(got, sorted(want, key=str)):
            assert g[2:] == pytest.approx(w[2:], rel=1e-12)
    text = plan(out)
    assert "collect_list" not in text and "percentile" not in text
    assert rollups.exact_quantiles(df.limit(0), "k", "v", [0.5]).count() == 0


# --- arrival


def test_arrival_keeps_what_does_not_fit(spark):
    texts = [
        '{"user_id":1,"value":2.5,"event_type":"x"}', '{"user_id":"7","value":"much","event_type":null}', '{"user_id":1.5,"value":1,"event_type":3,"z":1,"a":{}}',
        "{}", "[]", "7", '{"user_id":1', '{"user_id":1} x', '{"user_id":1}}', '{"user_id":1}]', '{"user_id":1},{"user_id":2}', "", None, '{"user_id":[1],"value":{"a":1}}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, json string")
    out = arrival.variant_arrival(df, "json", H.CONTRACT)
    assert out.columns == ["i", "user_id", "value", "event_type", "_unfit", "_missing", "_extra", "_malformed", "_variant"]
    got = {r.i: tuple(r)[1:8] for r in out.collect()}
    every = "user_id,value,event_type"
    assert got[0] == (1, 2.5, "x", "", "", "", None)
    assert got[1] == (7, None, None, "value", "event_type", "", None)
    assert got[2][1:] == (1.0, "3", "", "", "a,z", None)
    assert got[3] == (None, None, None, "", every, "", None)
    for i in (4, 5, 6, 7, 8, 9, 10, 11):
        assert got[i] == (None, None, None, "", every, "", texts[i])
    assert got[12] == (None, None, None, "", every, "", None)
    assert got[13] == (None, None, None, "user_id,value", "event_type", "", None)
    report = {r.field: tuple(r)[1:] for r in arrival.arrival_report(out, H.CONTRACT).collect()}
    assert report["value"] == (2, 2, 10, 8)
    assert "OBJECT" in arrival.arrival_schema(out).first()[0]
    assert arrival.variant_arrival(df.limit(0), "json", H.CONTRACT).count() == 0


# --- sessions


@pytest.mark.parametrize("longest", [None, 100])
def test_sessions_against_a_walk(spark, longest):
    rng = random.Random(8)
    t0 = dt.datetime(2024, 1, 1)
    log = [(rng.choice([1, 1, 1, 2, None]), rng.choice([None, rng.randint(0, 4000)]), rng.choice([True, False, None])) for _ in range(500)]
    log += [(9, 10 * i, True) for i in range(100)] + [(9, 0, False)]
    want = []
    for k in {k for k, *_ in log}:
        mine = sorted((t, bool(f)) for q, t, f in log if q == k and t is not None)
        run = []
        for t, f in [*mine, (None, None)]:
            if run and (t is None or t - run[-1][0] > 20):
                s, long = run[0][0], longest is not None and run[-1][0] - run[0][0] >= longest
                parts = {}
                for u, g in run:
                    parts.setdefault((u - s) // longest if long else 0, []).append((u, g))
                want += [(k, s, p, min(v)[0], max(v)[0], len(v), sum(g for _, g in v)) for p, v in parts.items()]
                run = []
            run.append((t, f))
    df = spark.createDataFrame([(k, None if t is None else t0 + dt.timedelta(seconds=t), f) for k, t, f in log], "k int, t timestamp_ntz, f boolean")
    out = sessions.sessions(df, "k", "t", 20, longest, F.col("f"))
    at = lambda t: t0 + dt.timedelta(seconds=t)
    assert rows(out) == sorted(((k, at(s), p, at(a), at(b), n, g) for k, s, p, a, b, n, g in want), key=str)
    assert sessions.sessions(df.limit(0), "k", "t", 20, longest).count() == 0


# --- readiness


def test_readiness_over_chains_and_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (1, 2), (4, 5), (5, 4), (6, 4), (7, 7), (8, 99), (9, None), (None, 1)], "process int, depends_on int")
    status = spark.createDataFrame([(1, "IDLE"), (2, "SUCCESS"), (3, "FAILED"), (4, "SUCCESS"), (5, "SUCCESS"), (6, "IDLE"), (7, "SUCCESS")], "process int, status string")
    procs = spark.createDataFrame([(i,) for i in range(1, 11)], "process int")
    got = {r.process: tuple(r)[1:] for r in readiness.transitive_readiness(procs, edges, status).collect()}
    assert got == {
        1: (2, 1, 3, False, False), 2: (1, 1, 3, False, False), 3: (0, 0, None, False, True), 4: (2, 2, None, True, False), 5: (2, 2, None, True, False),
        6: (2, 2, None, False, True), 7: (1, 1, None, True, False), 8: (1, 1, 99, False, False), 9: (0, 0, None, False, True), 10: (0, 0, None, False, True),
    }
    assert readiness.transitive_readiness(procs.limit(0), edges.limit(0), status).count() == 0


# --- buckets


def test_bucketed_sides_join_without_an_exchange(spark, plan, without_broadcast):
    text = plan(E.queries()["bucketed_flat_fact"](spark, SF))
    assert "SortMergeJoin" in text and "Exchange" not in text and f"{H.BUCKETS} out of {H.BUCKETS}" in text
