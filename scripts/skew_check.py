"""Skew evidence for the per-event audit, from Spark's own event log.

Derives a skewed outcome log from ``events`` (one process gets as many extra
outcomes as half the table, so it holds a third of all rows), then runs

* ``naive``: running counts with a window over the whole process, and
* ``vellum``: ``operators.runs.lifecycle_audit`` (range partitions + offsets),
* ``status``: ``operators.runs.lifecycle_status`` (partial aggregates),

each to completion, and reports, per stage, the largest and the median number
of shuffle records read by one task (from ``SparkListenerTaskEnd`` events).

Usage: python scripts/skew_check.py [sf_dir] [event_log_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from vellum.operators.runs import lifecycle_audit, lifecycle_status  # noqa: E402
from vellum.plans import standins as S  # noqa: E402
from vellum.session import build_session  # noqa: E402


def skewed_log(spark, sf_dir):
    log = S.outcome_log(spark, sf_dir)
    n = log.count()
    hot = log.orderBy("seq").limit(n // 2).select(
        F.lit(-1).cast("bigint").alias("process"), "ts", (F.col("seq") + F.lit(10**12)).alias("seq"), "ok"
    )
    return log.unionByName(hot)


def skewed_premiums(spark, sf_dir, path):
    """orders renamed as premiums, plus half as many rows again for one
    organizer (a third of the result)."""
    from vellum.plans import jobs

    prem = jobs.rename_project(S.premium_source(spark, sf_dir), jobs.PREMIUMS_RENAMES).select(
        "op", "cod_organizador", "prima_neta_componente"
    )
    hot_id = S.organizer_sources(spark, sf_dir)["SEHINT01"].where(
        F.col("ININTA") == S.ORGANIZER_TYPE_SEGMENT
    ).agg(F.min("ININNA")).first()[0]
    n = prem.count()
    extra = prem.orderBy("op").limit(n // 2).select(
        (F.col("op") + F.lit(10**12)).alias("op"), F.lit(hot_id).alias("cod_organizador"), "prima_neta_componente"
    )
    # Spread over many files, as a hot key is in a real fact: AQE splits a
    # skewed partition at map-output boundaries.
    prem.unionByName(extra).repartition(16).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def naive_audit(log):
    w = Window.partitionBy("process").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    return log.select(
        "*",
        F.sum((~F.col("ok")).cast("int")).over(w).alias("f"),
        F.sum(F.col("ok").cast("int")).over(w).alias("t"),
    )


def task_reads(log_dir, job_group):
    stages = {}
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in sorted(p for p in paths if "skewed_" not in p):
        with open(path, encoding="utf-8", errors="replace") as fh:
            for line in fh:
                try:
                    ev = json.loads(line)
                except ValueError:
                    continue
                if ev.get("Event") == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    if props.get("spark.jobGroup.id") == job_group:
                        for sid in ev.get("Stage IDs", []):
                            stages.setdefault(sid, [])
                elif ev.get("Event") == "SparkListenerTaskEnd" and ev.get("Stage ID") in stages:
                    m = ev.get("Task Metrics") or {}
                    rd = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    stages[ev["Stage ID"]].append(rd)
    return {sid: reads for sid, reads in stages.items() if reads and max(reads) > 0}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="run-skew-")
    spark = build_session(
        "local[8]",
        "skew-check",
        16,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            # Measure the operator itself, not AQE's runtime re-partitioning.
            "spark.sql.adaptive.skewJoin.enabled": "false",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Materialised first, so building it is not part of the measured jobs.
    skewed_path = os.path.join(log_dir, "skewed_log")
    skewed_log(spark, sf_dir).write.mode("overwrite").parquet(skewed_path)
    log = spark.read.parquet(skewed_path)
    total = log.count()
    hot = log.where("process = -1").count()
    builds = (("naive", naive_audit), ("vellum", lifecycle_audit), ("status", lifecycle_status))
    for name, build in builds:
        spark.sparkContext.setJobGroup(name, name)
        build(log).write.format("noop").mode("overwrite").save()
    # The flat fact when the dimension is over the broadcast bound: the fact is
    # shuffled for a sort-merge join; AQE's skew join must split the hot key.
    from vellum.operators.joins import flat_fact
    from vellum.plans.catalog import organizers

    spark.sparkContext.setJobGroup("prep", "prep")
    prem = skewed_premiums(spark, sf_dir, os.path.join(log_dir, "skewed_premiums"))
    org = organizers(spark, sf_dir).select("cod_organizador", "nombre", "grupo")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    for name, skew_join in (("smj", "false"), ("smj+aqe", "true")):
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", skew_join)
        spark.sparkContext.setJobGroup(name, name)
        flat_fact(prem, org, "cod_organizador").write.format("noop").mode(
            "overwrite"
        ).save()
    spark.sparkContext.setJobGroup("done", "done")
    spark.stop()
    print(f"rows {total}, hot process rows {hot} ({hot / total:.0%}), event log in {log_dir}")
    for name in [b[0] for b in builds] + ["smj", "smj+aqe"]:
        for sid, reads in sorted(task_reads(log_dir, name).items()):
            print(
                f"{name:7s} stage {sid:3d}: tasks {len(reads):3d}  max task reads {max(reads):7d}"
                f"  median {int(statistics.median(reads)):7d}"
            )


if __name__ == "__main__":
    main()
