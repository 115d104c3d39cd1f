"""Run-log queries over the driver's ``events`` table (the outcome log)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.operators import runs
from vellum.plans import standins as S
from vellum.session import ensure_checkpoint_dir


def process_edges(procs: DataFrame) -> DataFrame:
    """Stand-in dependency graph of the given processes, one row each:
    process p depends on p // 2 and p // 3 (when those differ from p)."""
    e2 = procs.select("process", (F.col("process") / 2).cast("bigint").alias("depends_on"))
    e3 = procs.select("process", (F.col("process") / 3).cast("bigint").alias("depends_on"))
    return e2.unionByName(e3).where(F.col("process") != F.col("depends_on")).distinct()


def run_log_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = S.outcome_log(spark, sf_dir)
    return runs.latest_runs(log, "process", "ts", "seq", ["ok"])


def lifecycle_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.lifecycle_status(S.outcome_log(spark, sf_dir))


def lifecycle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.lifecycle_audit(S.outcome_log(spark, sf_dir))


def run_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_duration(S.outcome_log(spark, sf_dir))


def may_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    # Processes and edges come from the status table, one row per process; written once, as it is used four times.
    status = runs.lifecycle_status(S.outcome_log(spark, sf_dir)).select("process", "status").checkpoint()
    procs = status.select("process")
    return runs.may_run(procs, process_edges(procs), status)


QUERIES = {
    "run_log_latest": run_log_latest,
    "lifecycle_status": lifecycle_status,
    "lifecycle_audit": lifecycle_audit,
    "run_duration": run_duration,
    "may_run": may_run,
}
