"""The run log as tables: lifecycle replay, audit, duration, may-run.

A process's status moves through a fixed transition table on each outcome
(true = the step went well). Fixed values, the whole table:

    IDLE    + true  -> RUNNING        IDLE    + false -> FAILED
    RUNNING + true  -> SUCCESS        RUNNING + false -> FAILED
    SUCCESS + true  -> IDLE           SUCCESS + false -> FAILED
    FAILED  + true  -> IDLE           FAILED  + false -> FAILED

Entering RUNNING stamps the start (and clears the end); entering SUCCESS or
FAILED stamps the end; returning to IDLE clears both. A duration exists only
for a terminal status with both stamps.

Replaying millions of outcomes does not need a sequential fold. With k = the
number of trues after the last false (or after the start if there is none):

    never false:   CYCLE[n_true % 3]
    k == 0:        FAILED (the last outcome was false)
    otherwise:     CYCLE[(k - 1) % 3]          CYCLE = IDLE, RUNNING, SUCCESS

so the final status needs only per-process aggregates. Outcomes are
non-NULL booleans, as the transition table's flag is (a NULL would be
counted without moving the state). The per-event audit
needs running counts per process; ``lifecycle_audit`` computes them without
putting a hot process in one task (range partitioning + prefix offsets).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.session import ensure_checkpoint_dir

IDLE, RUNNING, SUCCESS, FAILED = "IDLE", "RUNNING", "SUCCESS", "FAILED"
CYCLE = (IDLE, RUNNING, SUCCESS)


def _cycle(i: Column) -> Column:
    """CYCLE[i % 3] as a Column."""
    m = F.pmod(i, F.lit(3))
    return F.when(m == 0, F.lit(IDLE)).when(m == 1, F.lit(RUNNING)).otherwise(F.lit(SUCCESS))


def _ord(ts: str, seq: str) -> Column:
    return F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq"))


def lifecycle_status(
    log: DataFrame,
    key: str = "process",
    ts: str = "ts",
    seq: str = "seq",
    ok: str = "ok",
) -> DataFrame:
    """Final status per process: ``(key, status, outcomes, failures)``.

    Two aggregations, both partial on every partition, and one join of the log
    with the last-false mark of each process: two readings of the log. There is
    no hint and no measuring; adaptive execution broadcasts the marks when their
    real size is small.
    """
    marks = log.groupBy(key).agg(F.max(F.when(~F.col(ok), _ord(ts, seq))).alias("_last_false"))
    after = (
        log.join(marks, key)
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("outcomes"),
            F.count_if(~F.col(ok)).cast("bigint").alias("failures"),
            F.count_if(
                F.col(ok) & (F.col("_last_false").isNull() | (_ord(ts, seq) > F.col("_last_false")))
            ).cast("bigint").alias("_k"),
        )
    )
    k = F.col("_k")
    status = (
        F.when(F.col("failures") == 0, _cycle(k))
        .when(k == 0, F.lit(FAILED))
        .otherwise(_cycle(k - 1))
    )
    return after.select(key, status.alias("status"), "outcomes", "failures")


def _state(f: Column, t: Column, last_t: Column) -> Column:
    """Status after ``f`` falses and ``t`` trues, ``last_t`` = trues counted
    at the last false (NULL when there was none)."""
    return (
        F.when((f + t) == 0, F.lit(IDLE))
        .when(f == 0, _cycle(t))
        .when(t == last_t, F.lit(FAILED))
        .otherwise(_cycle(t - last_t - 1))
    )


def lifecycle_audit(
    log: DataFrame,
    key: str = "process",
    ts: str = "ts",
    seq: str = "seq",
    ok: str = "ok",
    partitions: int | None = None,
    checkpoint: bool = True,
) -> DataFrame:
    """One row per outcome: ``(key, ts, seq, ok, from_state, to_state)``.

    Per outcome we need three running values within its process, in (ts, seq)
    order: F = falses so far, T = trues so far, L = T at the last false so far.
    The status after any prefix is ``_state(F, T, L)``; from_state uses the
    values just before the outcome, to_state the values including it.

    Skew-safe: the log is range-partitioned on (key, ts, seq), so a process
    holding a third of the log spreads over many partitions. Each partition's
    slice of a process is scanned locally (window over (partition, key)); the
    slice totals -- at most (#partitions + #keys) rows -- give each slice its
    offsets from the slices before it. The slice scan is checkpointed to the
    shared checkpoint folder: partition ids are frozen and lineage is cut.
    In all the log is exchanged twice, by range and by (partition, key) for the
    windows: ranges are contiguous, so only the first process of a partition can
    have begun before it, and the offsets that matter are at most one row per
    partition, which are broadcast.
    """
    base = log.select(key, ts, seq, ok)
    # Without an explicit count AQE sizes the range partitions, merging only
    # adjacent ones, so every partition stays one contiguous (key, ts, seq)
    # range -- what the slice offsets rely on.
    if partitions:
        ranged = base.repartitionByRange(partitions, key, ts, seq)
    else:
        ranged = base.repartitionByRange(key, ts, seq)
    ranged = ranged.withColumn("_part", F.spark_partition_id())

    is_f = (~F.col(ok)).cast("int")
    w_in = Window.partitionBy("_part", key).orderBy(ts, seq)
    upto = w_in.rowsBetween(Window.unboundedPreceding, 0)
    before = w_in.rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select(
        "*",
        F.sum(is_f).over(upto).alias("_lf"),
        F.sum(F.col(ok).cast("int")).over(upto).alias("_lt"),
    )
    local = local.select(
        "*",
        # trues (within the slice) at the last false, including / excluding this row
        F.max(F.when(~F.col(ok), F.col("_lt"))).over(upto).alias("_ll"),
        F.max(F.when(~F.col(ok), F.col("_lt"))).over(before).alias("_ll_prev"),
    )
    if checkpoint:
        # Freezes the partition ids together with the slice-local running
        # values, so that the windows run once for both uses below.
        ensure_checkpoint_dir(local.sparkSession)
        local = local.checkpoint(eager=True)
    slices = local.groupBy("_part", key).agg(
        F.max("_lf").alias("_sf"),
        F.max("_lt").alias("_st"),
        F.max(F.when(~F.col(ok), F.col("_lt"))).alias("_sl"),
    )
    prev = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offs = slices.select(
        "_part",
        key,
        "_sl",
        F.coalesce(F.sum("_sf").over(prev), F.lit(0)).alias("_of"),
        F.coalesce(F.sum("_st").over(prev), F.lit(0)).alias("_ot"),
    )
    # Max over previous slices of their last-false T (global numbering).
    offs = offs.select(
        "_part", key, "_of", "_ot", F.max(F.col("_sl") + F.col("_ot")).over(prev).alias("_ol")
    )
    # Only a process that began in an earlier partition has offsets: one row per partition at most.
    continued = offs.where((F.col("_of") > 0) | (F.col("_ot") > 0))
    j = local.join(F.broadcast(continued), ["_part", key], "left").fillna(0, ["_of", "_ot"])
    f_now = F.col("_lf") + F.col("_of")
    t_now = F.col("_lt") + F.col("_ot")
    l_now = F.coalesce(F.col("_ll") + F.col("_ot"), F.col("_ol"))
    f_before = f_now - is_f
    t_before = t_now - F.col(ok).cast("int")
    l_before = F.coalesce(F.col("_ll_prev") + F.col("_ot"), F.col("_ol"))
    return j.select(
        key,
        ts,
        seq,
        ok,
        _state(f_before, t_before, l_before).alias("from_state"),
        _state(f_now, t_now, l_now).alias("to_state"),
    )


def run_duration(log: DataFrame, key: str = "process", ts: str = "ts", seq: str = "seq", ok: str = "ok") -> DataFrame:
    """Per process: ``(key, status, started, ended, duration_s)``.

    Only the end of a process's outcomes matters: the last true, the last false
    before it, and the number of trues in between (the last run of trues). That
    run leads to RUNNING (started by its last true), SUCCESS (started by the true
    before) or IDLE (not started); closing falses turn each into FAILED and keep
    the start. ended is the time of the last outcome, if the status is terminal.
    Three partial aggregations, the later two over the log joined with one mark
    per process; no order of the whole log is made.
    """
    o, yes = _ord(ts, seq), F.col(ok)
    ends = log.groupBy(key).agg(F.max(o).alias("_last"), F.max(F.when(yes, o)).alias("_true"))
    near = log.join(ends, key).groupBy(key).agg(
        F.any_value("_last").alias("_last"),
        F.any_value("_true").alias("_true"),
        F.max(F.when(~yes & (o < F.col("_true")), o)).alias("_false"),
        F.max(F.when(yes & (o < F.col("_true")), o)).alias("_before"),
    )
    run = log.join(near, key).groupBy(key).agg(
        *[F.any_value(c).alias(c) for c in ("_last", "_true", "_false", "_before")],
        F.count_if(yes & (F.col("_false").isNull() | (o > F.col("_false")))).alias("_n"),
    )
    reached = F.when(F.col("_true").isNull(), F.lit(IDLE)).otherwise(
        _cycle(F.when(F.col("_false").isNull(), F.col("_n")).otherwise(F.col("_n") - 1))
    )
    failed = F.col("_true").isNull() | (F.col("_true") < F.col("_last"))
    status = F.when(failed, F.lit(FAILED)).otherwise(reached)
    started = F.when(reached == RUNNING, F.col("_true.ts")).when(reached == SUCCESS, F.col("_before.ts"))
    terminal = status.isin(SUCCESS, FAILED)
    ended = F.when(terminal, F.col("_last.ts"))
    # timestamp_diff: independent of the session time zone for timestamp_ntz.
    secs = F.timestamp_diff("MICROSECOND", started, ended) / F.lit(1_000_000.0)
    return run.select(
        key, status.alias("status"), started.alias("started"), ended.alias("ended"), F.when(terminal, secs).alias("duration_s")
    )


def may_run(processes: DataFrame, edges: DataFrame, status: DataFrame, key: str = "process") -> DataFrame:
    """Per process: true when every dependency's status is SUCCESS (or none).

    ``edges`` has (key, ``depends_on``); ``status`` has (key, ``status``).
    """
    st = status.select(F.col(key).alias("depends_on"), F.col("status").alias("_dep_status"))
    j = processes.select(key).join(edges.select(key, "depends_on"), key, "left").join(st, "depends_on", "left")
    ok = F.when(F.col("depends_on").isNotNull(), F.coalesce(F.col("_dep_status") == SUCCESS, F.lit(False)))
    return j.groupBy(key).agg(
        F.coalesce(F.bool_and(ok), F.lit(True)).alias("may_run"),
        F.count("depends_on").alias("dependencies"),
    )


def latest_runs(log: DataFrame, key: str, ts: str, seq: str, cols: list[str]) -> DataFrame:
    """Per key, the latest row's ``cols`` (ordered by ts, then seq)."""
    o = _ord(ts, seq)
    per = log.groupBy(key).agg(
        F.max(o).alias("_last"),
        *[F.max_by(F.col(c), o).alias(f"last_{c}") for c in cols],
        F.count(F.lit(1)).alias("runs"),
    )
    return per.select(
        key,
        F.col("_last.ts").alias("last_ts"),
        F.col("_last.seq").alias("last_seq"),
        *[f"last_{c}" for c in cols],
        "runs",
    )
