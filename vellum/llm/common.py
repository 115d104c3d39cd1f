"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.session import ensure_checkpoint_dir, ship_package


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_RECORDS = 1000


def prepare(spark: SparkSession) -> None:
    """Make the package importable on the workers, know the shared folder, bound Arrow batches.

    A batch of whole documents is handed to a Python worker at once. Where the
    session has Spark's default of 10,000 records a batch, 1,000 are taken, so
    that batches of long texts stay small; a session's own value is left.
    """
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_RECORDS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


ROWS_A_PARTITION = 100_000


def checkpointed(df: DataFrame, rows: int | None = None, a_partition: int = ROWS_A_PARTITION) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder.

    ``rows``: about how many there are, of a few bytes each (else ``a_partition`` says how many go together);
    the table then gets as many partitions as they need, not as many as the session's shuffles have.
    """
    prepare(df.sparkSession)
    if rows is not None:
        needed = 1 + rows // a_partition
        if needed < session_partitions(df.sparkSession):
            df = df.coalesce(needed)
    return df.checkpoint(eager=True)


def without_estimate(df: DataFrame) -> DataFrame:
    """The rows of a checkpoint, of which the planner no longer holds an estimated size.

    A checkpoint keeps the estimate of the plan it cuts, and a join's estimate is the product of its
    sides'. In rounds of joins the number has twice the digits after each, until it fills the driver.
    Made anew from its rows, the table has the size Spark gives to any it knows nothing of.
    """
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(df._jdf.javaRDD(), df._jdf.schema()), spark)


def session_partitions(spark: SparkSession) -> int:
    """The shuffle width that the session asks for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def in_training(doc_id: str = "doc_id"):
    """Rows whose label may be learnt from: crc32 of the id as text, mod 3, is not 1."""
    return ~held_out(doc_id)


def held_out(doc_id: str = "doc_id"):
    """Rows kept back from training; a NULL id is held out of nothing (false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def text_chunks(values: Iterable, limit: int) -> Iterator[tuple[int, int]]:
    """Cut a run of byte strings into slices of about ``limit`` bytes (one row at least)."""
    start, size = 0, 0
    for i, v in enumerate(values):
        if i > start and size + len(v) > limit:
            yield start, i
            start, size = i, 0
        size += len(v)
    if start < len(values):
        yield start, len(values)


def utf8_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and the offsets of its rows; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Slices of rows whose bytes add up to about ``limit``, one row at least."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b
        a = b


def concat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes start..start+length of every row, one after another."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)
