"""Destinations: append a frame and report how many rows went in.

``write_counted`` counts rows *while writing* through an observed metric, so
the plan runs once (the warehouse loader ran it twice: count, then write).
Formats: ``parquet`` (default), ``csv``, ``jdbc`` (a warehouse reachable by
JDBC), or a catalog table (``table=`` with ``format=None``).
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _writer(df: DataFrame, fmt: str | None, mode: str, partition_by, options: dict | None):
    w = df.write.mode(mode)
    if fmt:
        w = w.format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w


def write_counted(
    df: DataFrame,
    path: str | None = None,
    *,
    table: str | None = None,
    fmt: str | None = "parquet",
    mode: str = "append",
    partition_by: str | list[str] | None = None,
    options: dict | None = None,
    metrics: list | None = None,
) -> dict:
    """Write ``df`` and return ``{"rows": n, "table": name, ...metrics}`` from
    the same job (``metrics``: extra aliased aggregate Columns to observe)."""
    obs = Observation("vellum_write")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *(metrics or []))
    w = _writer(observed, fmt, mode, partition_by, options)
    name = table or path
    if fmt == "jdbc":
        w.save()
    elif path is not None:
        w.save(path)
    elif table is not None:
        w.saveAsTable(table)
    else:
        raise ValueError("write_counted needs a path or a table")
    got = dict(obs.get)
    out = {"rows": int(got.pop("rows", 0) or 0), "table": name}
    out.update(got)
    return out


def drop_partitions(spark: SparkSession, path: str, column: str, values: list[str]) -> None:
    """Delete whole partitions of a written table through the table's own file system."""
    jvm = spark._jvm
    for value in values:
        where = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}={value}")
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def write_months(
    df: DataFrame,
    path: str,
    month_col: str = "month",
    mode: str = "overwrite",
    cluster_by: list[str] | None = None,
    metrics: list | None = None,
    rebalance: bool = True,
    since: datetime.date | None = None,
) -> dict:
    """One partitioned write for all months.

    ``overwrite`` replaces the months it writes (dynamic partition overwrite);
    with ``since``, the load's first month, it also removes the months from
    there on that the table still has and this load has not, so that a rerun
    with fewer months leaves exactly its own. ``append`` reproduces the
    warehouse's duplicate-on-rerun behaviour.

    Rows are rebalanced on the month first: each task then writes one month, so
    the file count is about months x (month size / advisory partition size)
    instead of input tasks x months; AQE splits a month holding a third of the
    data and coalesces small ones. ``rebalance=False`` leaves out that shuffle
    for inputs that arrive split by month. ``cluster_by`` adds columns to the
    rebalance key (finer spreading).
    """
    spark = df.sparkSession
    out = write_counted(
        df.hint("rebalance", month_col, *(cluster_by or [])) if rebalance else df,
        path,
        fmt="parquet",
        mode=mode,
        partition_by=month_col,
        metrics=[*(metrics or []), F.collect_set(F.date_format(month_col, "yyyy-MM-dd")).alias("_written")],
        # Per write, so a rerun replaces only its months whatever the session says.
        options={"partitionOverwriteMode": "dynamic"},
    )
    written = set(out.pop("_written", None) or [])
    if mode == "overwrite" and since is not None:
        # One row per month of the table.
        had = spark.read.parquet(path).select(F.date_format(month_col, "yyyy-MM-dd").alias("m")).distinct().collect() if written or _has_files(spark, path) else []
        drop_partitions(spark, path, month_col, sorted(r.m for r in had if r.m and r.m >= since.isoformat() and r.m not in written))
    return out


def _has_files(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(where) and any("=" in s.getPath().getName() for s in fs.listStatus(where))


def jdbc_options(url: str, table: str, driver: str | None = None, **extra) -> dict:
    opts = {"url": url, "dbtable": table}
    if driver:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items()})
    return opts
