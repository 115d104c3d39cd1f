"""Session construction and the shared work folder.

On a cluster the folder named by ``spark.checkpoint.dir`` is the shared
storage every executor can reach; checkpoints and written round-trip tables
go below it. Only when the session leaves it unset (local tests) do we pick
a folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A rerun of a month-partitioned load replaces only the months it writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Reliable checkpoints leave the shared folder once no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


_SHIPPED: set[str] = set()


def build_session(
    master: str | None = None,
    app_name: str = "vellum",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the library relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only if it is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(
                "spark.checkpoint.dir is unset: on a cluster name a folder there that all executors share"
            )
        # Local runs and tests only: driver and executor threads share this machine.
        configured = tempfile.mkdtemp(prefix="vellum-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    try:
        spark.conf.set("spark.checkpoint.dir", configured)
    except Exception:  # noqa: BLE001 - not settable at run time on every session kind
        pass
    return configured


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/vellum-" + name + "-" + uuid.uuid4().hex[:12]


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package, once per Spark application.

    The package's modules go into a small zip that Spark itself hands to every
    executor (``addPyFile``); where workers already have the package, as with
    an installed wheel, the copy is the same code.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="vellum-zip-"), "vellum_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme for the few stdlib helpers that need a path."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri



def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
