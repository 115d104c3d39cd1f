"""Run log: replay, audit, duration, may-run against a literal fold."""

import datetime as dt
import random

import pytest

from vellum.operators import runs

# The transition table, written out for the literal fold.
TRANSITIONS = {
    ("IDLE", True): "RUNNING",
    ("IDLE", False): "FAILED",
    ("RUNNING", True): "SUCCESS",
    ("RUNNING", False): "FAILED",
    ("SUCCESS", True): "IDLE",
    ("SUCCESS", False): "FAILED",
    ("FAILED", True): "IDLE",
    ("FAILED", False): "FAILED",
}


def fold(outcomes):
    """Literal replay: (states after each step, final, start, end)."""
    state, start, end, trail = "IDLE", None, None, []
    for ts, ok in outcomes:
        nxt = TRANSITIONS[(state, ok)]
        if nxt == "RUNNING":
            start, end = ts, None
        elif nxt in ("SUCCESS", "FAILED"):
            end = ts
        else:
            start, end = None, None
        trail.append((state, nxt))
        state = nxt
    dur = (end - start).total_seconds() if start and end and state in ("SUCCESS", "FAILED") else None
    return trail, state, dur


T0 = dt.datetime(2024, 1, 1)


def log_frame(spark, seqs):
    rows, seq = [], 0
    for p, outcomes in seqs.items():
        for i, ok in enumerate(outcomes):
            rows.append((p, T0 + dt.timedelta(minutes=i), seq, ok))
            seq += 1
    return spark.createDataFrame(rows, "process bigint, ts timestamp_ntz, seq bigint, ok boolean")


CASES = {
    "T": "RUNNING",
    "F": "FAILED",
    "TT": "SUCCESS",
    "TF": "FAILED",
    "TTT": "IDLE",
    "FT": "IDLE",
    "FF": "FAILED",
}


def test_lifecycle_cases(spark):
    seqs = {i: [c == "T" for c in k] for i, k in enumerate(CASES)}
    got = {r.process: r.status for r in runs.lifecycle_status(log_frame(spark, seqs)).collect()}
    assert got == {i: v for i, v in enumerate(CASES.values())}


def test_duration_cases(spark):
    seqs = {0: [True, True], 1: [True, False], 2: [True]}
    got = {r.process: r.duration_s for r in runs.run_duration(log_frame(spark, seqs)).collect()}
    assert got[0] == 60.0 and got[1] == 60.0 and got[2] is None


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_random_logs_match_literal_fold(spark, partitions):
    rnd = random.Random(partitions)
    # One hot process with most outcomes, many small ones.
    seqs = {0: [rnd.random() > 0.25 for _ in range(400)]}
    for p in range(1, 25):
        seqs[p] = [rnd.random() > 0.3 for _ in range(rnd.randint(1, 12))]
    log = log_frame(spark, seqs)
    status = {r.process: r.status for r in runs.lifecycle_status(log).collect()}
    audit = runs.lifecycle_audit(log, partitions=partitions)
    trails = {}
    for r in audit.orderBy("process", "ts", "seq").collect():
        trails.setdefault(r.process, []).append((r.from_state, r.to_state))
    durations = {r.process: r.duration_s for r in runs.run_duration(log).collect()}
    for p, outcomes in seqs.items():
        stamped = [(T0 + dt.timedelta(minutes=i), ok) for i, ok in enumerate(outcomes)]
        trail, final, dur = fold(stamped)
        assert status[p] == final, p
        assert trails[p] == trail, p
        assert durations[p] == dur, p


def test_durations_of_all_short_logs(spark):
    import itertools

    seqs = {i: list(c) for i, c in enumerate(c for n in range(1, 9) for c in itertools.product([True, False], repeat=n))}
    got = {r.process: r for r in runs.run_duration(log_frame(spark, seqs)).collect()}
    for p, outcomes in seqs.items():
        _, final, dur = fold([(T0 + dt.timedelta(minutes=i), ok) for i, ok in enumerate(outcomes)])
        assert (got[p].status, got[p].duration_s) == (final, dur), outcomes


def test_may_run(spark):
    processes = spark.createDataFrame([(i,) for i in range(6)], "process bigint")
    status = spark.createDataFrame(
        [(10, "SUCCESS"), (11, "SUCCESS"), (12, "RUNNING"), (13, "FAILED"), (14, "IDLE")],
        "process bigint, status string",
    )
    edges = spark.createDataFrame(
        [(1, 10), (1, 11), (2, 10), (2, 12), (3, 13), (4, 14), (5, 99)], "process bigint, depends_on bigint"
    )
    got = {r.process: r.may_run for r in runs.may_run(processes, edges, status).collect()}
    assert got == {0: True, 1: True, 2: False, 3: False, 4: False, 5: False}


def test_latest_runs(spark):
    log = log_frame(spark, {7: [True, False, True]})
    r = runs.latest_runs(log, "process", "ts", "seq", ["ok"]).first()
    assert r.last_ok is True and r.runs == 3 and r.last_seq == 2


def test_duration_ignores_session_time_zone(spark):
    rows = [(1, dt.datetime(2024, 3, 31, 1, 30), 0, True), (1, dt.datetime(2024, 3, 31, 3, 30), 1, True)]
    log = spark.createDataFrame(rows, "process bigint, ts timestamp_ntz, seq bigint, ok boolean")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        r = runs.run_duration(log).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.status == "SUCCESS" and r.duration_s == 7200.0


def test_month_rewrite_is_dynamic_without_session_setting(spark, workdir):
    from vellum.sinks import write_months

    df = spark.createDataFrame([(dt.date(2025, 1, 1), 1), (dt.date(2025, 2, 1), 2)], "month date, v int")
    path = workdir("months")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        write_months(df, path)
        write_months(df.where("v = 2"), path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert spark.read.parquet(path).count() == 2
