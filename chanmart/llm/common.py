"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import sys
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanmart.session import checkpoint_dir, staging_path

_REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


BATCH_CONF, BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
#: Rows of an Arrow batch where the session keeps Spark's default: rows here are whole texts.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Make the package importable in Python workers and a shared checkpoint folder known.

    The folder is the one the session names in ``spark.checkpoint.dir``; a
    temporary one is made only where none is named and all tasks run on this
    machine (tests, local runs).  A cluster without the setting is an error.
    Arrow batches hold ``BATCH_ROWS`` rows from now on, unless the session has
    a batch size of its own.
    """
    if spark.conf.get(BATCH_CONF) == BATCH_DEFAULT:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _REPO not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_REPO, *paths])
    if _REPO not in sys.path:
        sys.path.insert(0, _REPO)
    local = spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="chanmart-llm-") if local and not named else None)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once under the shared checkpoint folder and return the written table.

    Cuts the lineage: a lost executor costs the files' readers, not the work
    that made them, and values drawn once (row numbers) stay as they are.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def crc32_of_id(column):
    """crc32 of an id written as decimal text (NULL id: of the empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")))


def flat_text(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column, NULL as empty, and the n+1 offsets into them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    flat = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return flat, at - at[0]


def byte_texts(column) -> list[bytes]:
    """The texts of a column as UTF-8 bytes, NULL as empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def few_texts(texts: list[bytes], most: int):
    """Ranges of texts of about ``most`` bytes together, so that memory does not follow the batch."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def replaced(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    """The batch with one column's values replaced, its name, place and type kept."""
    at = batch.schema.get_field_index(name)
    columns = list(batch.columns)
    columns[at] = values.cast(batch.schema.field(at).type)
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def release() -> None:
    """Give freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run):
    """Wrap a task's batch function so that freed memory goes back to the system when the task ends.

    Python workers outlive their tasks; without this each keeps the peak of
    every operator it has ever run.
    """

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


#: Keys that hold more than one row in so many are hot; by count there are fewer such keys than this.
HOT_KEYS = 1000


def join_spread(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on ``key`` where one key may hold a third of ``left``'s rows; ``right`` has each key once at most.

    ``left`` should be a written table: it is read once to count its keys.  Keys
    with more than a ``HOT_KEYS``-th of its rows (so fewer than ``HOT_KEYS``
    keys, of which ``right`` has one row each) meet their row by broadcast and
    are not shuffled; the others are hash joined.  ``key`` must be of bounded
    size (a number or a digest); rows with a NULL key have no partner.
    """
    counts = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    least = left.count() // HOT_KEYS
    few = staged(counts.filter(F.col("n") > max(least, 1000)).select(key).limit(HOT_KEYS), "hot-keys")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
    alone = left.filter(F.col(key).isNull()).select(*left.columns, *none)
    rest = left.filter(F.col(key).isNotNull())
    columns = [*left.columns, *(c for c in right.columns if c != key)]
    if not few.count():
        return rest.join(right, key, "left").select(*columns).unionByName(alone)
    of_hot = staged(right.join(F.broadcast(few), key, "left_semi"), "hot-rows")
    cold = rest.join(F.broadcast(few), key, "left_anti").join(right, key, "left").select(*columns)
    warm = rest.join(F.broadcast(few), key, "left_semi").join(F.broadcast(of_hot), key, "left").select(*columns)
    return cold.unionByName(warm).unionByName(alone)
