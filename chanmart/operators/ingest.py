"""Loading message files into the raw table: validate, load once, count, stamp ids.

Every step is a DataFrame transformation; the caller decides when to write.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanmart.functions import json_fields as J
from chanmart.session import allow_duplicate_json_keys


def classify_messages(files: DataFrame) -> DataFrame:
    """Parse each file once and attach its reject reason (NULL = loadable).

    In: ``(file_path, value, ...)``.  Out: the input columns plus
    ``reject_reason``, ``raw_data`` (normalised JSON text), ``message_id``,
    ``channel_id``.
    """
    allow_duplicate_json_keys(files.sparkSession)
    # One parse per file: the reason, the normalised text and both ids all
    # read the same variant.
    parsed = J.with_rule_values(J.with_parsed(files, "value", keep=files.columns))
    doc = F.col("_doc")
    return parsed.select(
        *files.columns,
        J.reject_reason(doc, F.col("value")).alias("reject_reason"),
        J.normalized_json(doc).alias("raw_data"),
        J.id_field().alias("message_id"),
        J.channel_field().alias("channel_id"),
    )


def valid_messages(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reject_reason").isNull()).select(
        "file_path", "message_id", "channel_id", "raw_data"
    )


def rejected_messages(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reject_reason").isNotNull()).select(
        "file_path", "reject_reason", F.col("value").alias("raw_text")
    )


def split_valid_messages(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Route files to (valid, rejects); rejects carry the reason and the original text."""
    classified = classify_messages(files)
    return valid_messages(classified), rejected_messages(classified)


def append_new_messages(existing: DataFrame, incoming: DataFrame, key: str = "file_path") -> DataFrame:
    """Rows of ``incoming`` whose ``key`` is not loaded yet, each key once.

    The de-duplication and the anti-join both hash-partition on ``key``, so
    the incoming side is shuffled once; the existing side contributes only
    its key column.
    """
    return incoming.dropDuplicates([key]).join(existing.select(key), key, "left_anti").select(*incoming.columns)


def ingest_stats(classified: DataFrame, existing: DataFrame, key: str = "file_path") -> DataFrame:
    """One row: files seen, loaded (new and valid), already loaded, rejected."""
    seen = existing.select(key).distinct().withColumn("_seen", F.lit(True))
    flagged = classified.select(key, "reject_reason").join(seen, key, "left")
    valid = F.col("reject_reason").isNull()
    was_seen = F.col("_seen").isNotNull()
    return flagged.agg(
        F.count(F.lit(1)).alias("files_seen"),
        F.count_if(valid & ~was_seen).alias("loaded"),
        F.count_if(valid & was_seen).alias("already_loaded"),
        F.count_if(~valid).alias("rejected"),
    )


def next_id(existing: DataFrame, id_col: str = "id") -> Column:
    """max(existing id) + 1 (1 for an empty table), as a scalar subquery."""
    return existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_m")).scalar() + F.lit(1)


def with_load_metadata(
    df: DataFrame,
    existing: DataFrame | None = None,
    loaded_at: _dt.datetime | None = None,
    id_col: str = "id",
    start: int | None = None,
) -> DataFrame:
    """Stamp a surrogate id (unique, increasing, gaps allowed) and the load time.

    Ids start at ``start`` when given (the pipeline keeps a per-table
    watermark), else after the maximum id of ``existing`` (a scalar
    subquery), else at 1.  The ids depend on the physical partitioning, so a
    stamped frame must be written (or checkpointed) once and then read back,
    never recomputed.
    """
    if start is not None:
        start = F.lit(int(start)).cast("long")
    else:
        start = next_id(existing, id_col) if existing is not None else F.lit(1)
    stamp = F.lit(loaded_at).cast("timestamp") if loaded_at is not None else F.current_timestamp()
    return df.select((start + F.monotonically_increasing_id()).alias(id_col), "*", stamp.alias("loaded_at"))
