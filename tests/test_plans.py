"""Plan-shape regression tests: the scale properties, read from explain()."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def plan(spark, capsys):
    def _plan(key: str) -> str:
        capsys.readouterr()
        E.queries()[key](spark, SF).explain("formatted")
        return capsys.readouterr().out

    return _plan


def scans(text: str) -> int:
    return sum(1 for line in text.splitlines() if line.startswith("(") and "Scan parquet" in line)


@pytest.fixture()
def without_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_run_log_plans_without_broadcast(plan, without_broadcast):
    status = plan("lifecycle_status")
    assert scans(status) == 2 and "Broadcast" not in status
    duration = plan("run_duration")
    assert scans(duration) == 3 and "Window" not in duration and "rangepartitioning" not in duration
    # The audit's log was exchanged by range and for the windows before its checkpoint; what is left is no exchange of rows.
    audit = plan("lifecycle_audit")
    assert "SortMergeJoin" not in audit and "BroadcastHashJoin" in audit and scans(audit) == 0
    # Processes and edges come from the status table, not from the log.
    assert scans(plan("may_run")) == 0


def test_premiums_load_has_no_join(spark, capsys):
    from vellum.plans import jobs, standins

    capsys.readouterr()
    jobs.build_premiums(spark, 1995, {jobs.PREMIUMS_SOURCE: standins.premium_source(spark, SF)}).explain("formatted")
    p = capsys.readouterr().out
    assert "Join" not in p and "Subquery" in p


def test_pre_checks_read_each_check_once(plan):
    assert scans(plan("pre_checks")) == 3


def test_month_range_reaches_the_scan(plan):
    p = plan("month_slice")
    assert "GreaterThanOrEqual(o_orderdate,1998-03-01T00:00)" in p
    assert "LessThan(o_orderdate,1998-04-01T00:00)" in p


def test_projection_is_pruned_at_the_scan(plan):
    assert "ReadSchema: struct<p_name:string,p_type:string>" in plan("normalise_distinct")
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan("month_counts")


def test_month_prefix_scans_the_fact_once(plan):
    p = plan("month_prefix")
    scans = [line for line in p.splitlines() if line.startswith("(") and "Scan parquet" in line]
    assert len(scans) == 1 and "NestedLoop" not in p and "Subquery" not in p


def test_status_replay_has_no_window_and_aggregates_partially(plan):
    p = plan("lifecycle_status")
    assert "Window" not in p
    assert "partial_count" in p


def test_flat_fact_reads_each_side_once(plan):
    p = plan("flat_fact")
    assert scans(p) == 5 and "LeftOuter" in p


def test_organizers_shuffles_at_most_twice(plan):
    p = plan("organizers")
    # Shuffle join: its two exchanges also serve the distinct. Broadcast join
    # (small inputs): only the distinct's exchange of partial aggregates.
    assert p.count("hashpartitioning(") <= 2
