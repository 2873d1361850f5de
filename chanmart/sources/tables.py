"""Named tables under a warehouse root (versioned Parquet, see ``snapshots``), and the generated inputs."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from chanmart.sources import snapshots as SN

# The warehouse's table names.
RAW_MESSAGES = "raw_messages"
RAW_REJECTS = "raw_message_rejects"
RAW_IMAGE_DETECTIONS = "raw_image_detections"
RAW_IMAGE_FAILURES = "raw_image_failures"
STG_MESSAGES = "stg_telegram_messages"
STG_DETECTIONS = "stg_image_detections"
DIM_CHANNELS = "dim_channels"
DIM_DATES = "dim_dates"
FCT_MESSAGES = "fct_messages"
FCT_IMAGE_DETECTIONS = "fct_image_detections"
RPT_WORD_COUNTS = "rpt_word_counts"
RPT_CHANNEL_DAYS = "rpt_channel_day_counts"
RPT_PERIOD_WORDS = "rpt_period_word_counts"
MESSAGE_KEYS = "message_keys"
CHECK_KEYS = "check_keys"
SEARCH_INDEX = "search_index"


def read_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the generated test tables (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def table_path(root: str, name: str) -> str:
    return os.path.join(root, name)


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    return SN.snapshot(spark, root, name) is not None or _plain(spark, root, name)


def _plain(spark: SparkSession, root: str, name: str) -> bool:
    """Whether the table is a plain Parquet folder, written by other means."""
    return SN.exists(spark, table_path(root, name)) and not SN.exists(spark, SN.pointer_path(root, name))


def _declared_schema(name: str):
    from chanmart import schemas as SC

    return {
        RAW_MESSAGES: SC.RAW_MESSAGES,
        RAW_REJECTS: SC.RAW_REJECTS,
        RAW_IMAGE_DETECTIONS: SC.RAW_IMAGE_DETECTIONS,
        RAW_IMAGE_FAILURES: SC.RAW_IMAGE_FAILURES,
        STG_MESSAGES: SC.STG_MESSAGES,
        FCT_MESSAGES: SC.FCT_MESSAGES,
    }.get(name)


def read_table(spark: SparkSession, root: str, name: str, schema=None, dates=None, since: int = 0) -> DataFrame:
    """Read the present version of a warehouse table; an absent one reads as empty when its schema is known.

    ``dates`` (values of the table's one partition column) limits the read to
    those partition folders: the others aren't even listed.  ``since`` limits
    it to the rows of writes after that number (see ``snapshots``).
    """
    version = SN.snapshot(spark, root, name)
    if version is not None:
        partitions = None if dates is None else [f"{version.partition_by[0]}={d}" for d in dates]
        return SN.read_snapshot(spark, root, name, partitions, since, version)
    schema = schema if schema is not None else _declared_schema(name)
    if not _plain(spark, root, name):
        if schema is None:
            raise FileNotFoundError(f"no table {name} under {root}")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(root, name))


def write_table(df: DataFrame, root: str, name: str, mode: str = "overwrite", partition_by=None, meta: dict | None = None, sort_by=(), replaced=None):
    """Write a new version of a table: readers see it whole or not at all.

    ``mode``: ``overwrite``, ``append``, or ``partitions`` (those that ``df``
    has rows of, and those named in ``replaced``, are replaced).  Rows of one
    partition folder are brought together, files are sorted by ``sort_by``.
    """
    if mode != "overwrite" and _plain(df.sparkSession, root, name):
        raise ValueError(f"{name} under {root} is a plain folder: read it and write it once with mode='overwrite'")
    df = distributed(df, partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*(partition_by or ()), *sort_by)
    return SN.write_snapshot(df, root, name, mode, partition_by or (), meta, replaced=replaced)


def distributed(df: DataFrame, partition_by) -> DataFrame:
    """Rows of one partition folder brought together, so that it holds few files; AQE splits a large folder's rows again."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def meta(spark: SparkSession, root: str, name: str) -> dict:
    """The record that a table's writer keeps with it ({} before the first write)."""
    version = SN.snapshot(spark, root, name)
    return version.meta if version else {}


def written(spark: SparkSession, root: str, name: str) -> int:
    """Number of a table's last write (0 before the first)."""
    version = SN.snapshot(spark, root, name)
    return version.seq if version else 0


def register_views(spark: SparkSession, root: str, names) -> None:
    """Expose warehouse tables as temp views for SQL callers."""
    for name in names:
        read_table(spark, root, name).createOrReplaceTempView(name)


# Surrogate ids are ``start + monotonically_increasing_id()``; the latter puts
# the partition index in the bits from 33 up.
_ROWS_PER_PARTITION_BITS = 33


def read_next_id(spark: SparkSession, root: str, name: str, id_col: str = "id") -> int:
    """First unused surrogate id of a table, kept with it by ``append_rows_with_ids``.

    Where a table has rows of other means, it is computed once from the
    table's maximum id.
    """
    kept = meta(spark, root, name).get("next_id")
    if kept is not None:
        return int(kept)
    if table_exists(spark, root, name):
        top = read_table(spark, root, name).agg({id_col: "max"}).first()[0]
        return int(top) + 1 if top is not None else 1
    return 1


def next_id_after(start: int, num_partitions: int) -> int:
    """An id above every one that a frame stamped from ``start`` with so many partitions can hold.

    Such a frame holds ids below ``start + num_partitions * 2**33`` (gaps are
    allowed), so no pass over the written rows is needed.
    """
    return start + (max(num_partitions, 1) << _ROWS_PER_PARTITION_BITS)
