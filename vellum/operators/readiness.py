"""Readiness over whole chains of prerequisites.

The transitive closure of the dependency edges grows a level at a time: the pairs
found last are joined with the edges, and what is new is kept. There are as many
rounds as the longest shortest chain has steps, whatever the number of processes;
each round is a Spark job over pairs, and a cycle ends it like any other chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.operators.runs import SUCCESS
from vellum.session import ensure_checkpoint_dir


def prerequisites(edges: DataFrame, key: str = "process", needs: str = "depends_on") -> DataFrame:
    """``key``, ``needs``, ``depth``: every process a process waits for, with the fewest steps between; itself too, if it lies on a cycle.

    Edges that repeat count once; edges with a NULL on either side lead nowhere.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    step = edges.select(F.col(key).alias("_from"), F.col(needs).alias("_to")).where("_from IS NOT NULL AND _to IS NOT NULL").distinct().checkpoint()
    known = frontier = step.select(F.col("_from").alias(key), F.col("_to").alias(needs), F.lit(1).alias("depth")).checkpoint()
    depth = 1
    while not frontier.isEmpty():
        depth += 1
        reached = frontier.join(step, F.col(needs) == F.col("_from")).select(key, F.col("_to").alias(needs)).distinct()
        frontier = reached.join(known.select(key, needs), [key, needs], "left_anti").withColumn("depth", F.lit(depth)).checkpoint()
        known = known.unionByName(frontier)
    return known


def transitive_readiness(processes: DataFrame, edges: DataFrame, status: DataFrame, key: str = "process") -> DataFrame:
    """Per process: prerequisites, depth, first_blocking, in_cycle, may_run over all that it waits for, directly or not.

    ``depth`` is the number of steps to the farthest prerequisite (0 without any); ``first_blocking`` the nearest
    one whose status is not SUCCESS, of equally near ones the smallest; a process on a cycle waits for itself and may not run.
    A prerequisite without a status blocks.
    """
    pairs = prerequisites(edges, key)
    done = status.select(F.col(key).alias("depends_on"), (F.col("status") == SUCCESS).alias("_done"))
    judged = pairs.join(done, "depends_on", "left").withColumn("_done", F.coalesce("_done", F.lit(False)))
    per = judged.groupBy(key).agg(
        F.count("*").alias("prerequisites"),
        F.max("depth").alias("depth"),
        F.min(F.when(~F.col("_done"), F.struct("depth", "depends_on")))["depends_on"].alias("first_blocking"),
        F.bool_or(F.col(key) == F.col("depends_on")).alias("in_cycle"),
        F.bool_and("_done").alias("_all"),
    )
    out = processes.select(key).join(per, key, "left")
    cycle = F.coalesce("in_cycle", F.lit(False))
    return out.select(
        key, F.coalesce("prerequisites", F.lit(0).cast("long")).alias("prerequisites"), F.coalesce("depth", F.lit(0)).alias("depth"), "first_blocking",
        cycle.alias("in_cycle"), (F.coalesce("_all", F.lit(True)) & ~cycle).alias("may_run"),
    )
