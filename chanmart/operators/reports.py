"""Report queries over the marts; each returns a lazy DataFrame.

Ordering follows the warehouse: ``DESC`` sorts put NULLs first, ``ASC``
sorts put them last.  Top-k ties are broken by the key ascending so results
are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanmart.functions import text as TX
from chanmart.functions.dates import day_of

# Default result sizes.
SEARCH_LIMIT = 100
TOP_LIMIT = 10


def search_messages(fct_messages: DataFrame, query: str, limit: int = SEARCH_LIMIT) -> DataFrame:
    """Newest messages whose text contains ``query`` (case-insensitive, ILIKE '%query%').

    The filter runs in the scan stage; the order+limit becomes a per-partition
    top-k merged on the driver side of the plan (TakeOrderedAndProject), so no
    full sort or shuffle of the matches happens.
    """
    hits = fct_messages.filter(TX.contains_ci(F.col("message_text"), query))
    return (
        hits.select("message_id", "message_text", "channel_id", "message_posted_at")
        .orderBy(F.col("message_posted_at").desc_nulls_first(), F.col("message_id").asc_nulls_last())
        .limit(limit)
    )


def product_mentions(fct_messages: DataFrame) -> DataFrame:
    """(product_name, mention_count) for every counted word, no limit.

    Words are exploded inside the scan stage and counted with a partial
    aggregation before the shuffle, so a very frequent word costs one row per
    map task, not one per mention.
    """
    words = fct_messages.filter(F.col("message_text").isNotNull()).select(
        F.explode(TX.words(F.col("message_text"))).alias("word")
    )
    return (
        words.filter(TX.is_product_word(F.col("word")))
        .groupBy(F.col("word").alias("product_name"))
        .agg(F.count(F.lit(1)).alias("mention_count"))
    )


def top_products(fct_messages: DataFrame, limit: int = TOP_LIMIT) -> DataFrame:
    """Most mentioned words longer than 3 characters, stop words excluded."""
    return (
        product_mentions(fct_messages)
        .orderBy(F.col("mention_count").desc_nulls_first(), F.col("product_name").asc_nulls_last())
        .limit(limit)
    )


def channel_activity(fct_messages: DataFrame, channel_id: int) -> DataFrame:
    """Posts per day (``post_date`` as yyyy-MM-dd text) for one channel, by date."""
    rows = fct_messages.filter(F.col("channel_id") == F.lit(channel_id))
    return _daily_counts(rows)


def _daily_counts(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy(day_of(F.col("message_posted_at")).cast("string").alias("post_date"))
        .agg(F.count("message_id").alias("post_count"))
        .orderBy(F.col("post_date").asc_nulls_last())
    )


def top_detected_objects(fct_image_detections: DataFrame, limit: int = TOP_LIMIT) -> DataFrame:
    """Most frequent detected classes."""
    return (
        fct_image_detections.groupBy(F.col("detected_object_class").alias("object_class"))
        .agg(F.count("detection_id").alias("detection_count"))
        .orderBy(F.col("detection_count").desc_nulls_first(), F.col("object_class").asc_nulls_last())
        .limit(limit)
    )


def channel_id_by_name(dim_channels: DataFrame, channel_name: str) -> DataFrame:
    """At most one row: the id of the channel with this name."""
    return dim_channels.filter(F.col("channel_name") == F.lit(channel_name)).select("channel_id").limit(1)


def channel_activity_for_name(fct_messages: DataFrame, dim_channels: DataFrame, channel_name: str) -> DataFrame:
    """Daily activity of the channel named ``channel_name``, as one lazy plan.

    The name lookup yields at most one row (``limit(1)``), so broadcasting it
    is bounded; the facts are filtered by a semi-join without a shuffle.
    An unknown name gives an empty result; ``channel_activity_by_name`` raises
    instead.
    """
    chosen = F.broadcast(channel_id_by_name(dim_channels, channel_name))
    return _daily_counts(fct_messages.join(chosen, "channel_id", "left_semi"))


def channel_activity_by_name(fct_messages: DataFrame, dim_channels: DataFrame, channel_name: str) -> DataFrame:
    """Daily activity for a channel name; ``KeyError`` when no channel has that name.

    The lookup is a one-row action (at most one id crosses to the driver);
    a known channel with no messages gives an empty frame.
    """
    found = channel_id_by_name(dim_channels, channel_name).take(1)
    if not found:
        raise KeyError(f"Channel '{channel_name}' not found.")
    return channel_activity(fct_messages, found[0]["channel_id"])


# --- report rollups ------------------------------------------------------------
# Partial counts kept per lake-date partition by the incremental mart build;
# a report then sums the partials instead of scanning every message.


def word_count_rollup(fct_messages: DataFrame, partition_col: str = "lake_date") -> DataFrame:
    """(lake_date, product_name, mention_count) for the given message partitions."""
    words = fct_messages.filter(F.col("message_text").isNotNull()).select(
        partition_col, F.explode(TX.words(F.col("message_text"))).alias("word")
    )
    return (
        words.filter(TX.is_product_word(F.col("word")))
        .groupBy(partition_col, F.col("word").alias("product_name"))
        .agg(F.count(F.lit(1)).alias("mention_count"))
    )


def top_products_from_rollup(rollup: DataFrame, limit: int = TOP_LIMIT) -> DataFrame:
    """``top_products`` answered from word-count partials (same result)."""
    return (
        rollup.groupBy("product_name")
        .agg(F.sum("mention_count").alias("mention_count"))
        .orderBy(F.col("mention_count").desc_nulls_first(), F.col("product_name").asc_nulls_last())
        .limit(limit)
    )


def channel_day_rollup(fct_messages: DataFrame, partition_col: str = "lake_date") -> DataFrame:
    """(lake_date, channel_id, post_date, post_count) for the given message partitions."""
    return fct_messages.groupBy(
        partition_col, "channel_id", day_of(F.col("message_posted_at")).cast("string").alias("post_date")
    ).agg(F.count("message_id").alias("post_count"))


def channel_activity_from_rollup(rollup: DataFrame, channel_id: int) -> DataFrame:
    """``channel_activity`` answered from per-day partials (same result)."""
    return (
        rollup.filter(F.col("channel_id") == F.lit(channel_id))
        .groupBy("post_date")
        .agg(F.sum("post_count").alias("post_count"))
        .orderBy(F.col("post_date").asc_nulls_last())
    )
