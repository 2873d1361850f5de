"""Which messages and photos land in the lake: channel allow-list, newest-n cap, photo worklist."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanmart.functions.dates import day_of
from chanmart.sources.lake import image_file_path

# Fixed value: messages taken per channel per run.
MESSAGES_PER_CHANNEL = 200
# Sub-groups per channel in the first top-n pass (see latest_per_channel).
TOP_N_FANOUT = 64


def filter_channels(df: DataFrame, channels: Iterable | DataFrame, column: str = "channel_id") -> DataFrame:
    """Keep rows of allowed channels.

    A Python list becomes an IN-list (pushed to the scan); an allow-list held
    in a DataFrame is applied as a semi-join, so it never passes through the
    driver.  The join needs no distinct list, and with no aggregate between
    shuffle and join a hot channel's partition can be split.
    """
    if isinstance(channels, DataFrame):
        allowed = channels.select(F.col(channels.columns[0]).alias(column))
        return df.join(allowed, column, "left_semi").select(*df.columns)
    return df.filter(F.col(column).isin(list(channels)))


def latest_per_channel(
    df: DataFrame,
    n: int = MESSAGES_PER_CHANNEL,
    channel: str = "channel_id",
    order: str = "message_id",
    fanout: int = TOP_N_FANOUT,
) -> DataFrame:
    """The ``n`` newest rows (highest ``order``) of each channel.

    Exact, and no channel is ever merged by one task from all map tasks:

    1. every map task keeps its own top ``n`` per channel (Spark's partial
       window-group limit, before the shuffle), and rows are keyed by
       (channel, map-task id mod ``fanout``), so the top-``n`` merge of a huge
       channel is spread over ``fanout`` tasks, each seeing the survivors of
       1/``fanout`` of the map tasks;
    2. a second top-``n`` per channel merges at most ``fanout * n`` rows.

    Each of a channel's top ``n`` rows is in the top ``n`` of its own sub-group,
    so the result equals a single top-``n`` over the channel.  The sub-group
    is the task's split index, which is the same when a task is re-run.
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(fanout))
    ranked = F.col(order).desc_nulls_last()
    w1 = Window.partitionBy(F.col(channel), F.col("_salt")).orderBy(ranked)
    w2 = Window.partitionBy(F.col(channel)).orderBy(ranked)
    first = (
        df.withColumn("_salt", salt)
        .withColumn("_rn", F.row_number().over(w1))
        .filter(F.col("_rn") <= n)
        .drop("_rn", "_salt")
    )
    return first.withColumn("_rn", F.row_number().over(w2)).filter(F.col("_rn") <= n).drop("_rn")


def photo_worklist(
    messages: DataFrame,
    existing_images: DataFrame,
    channels: Iterable | DataFrame | None = None,
) -> DataFrame:
    """Photos to download: (image_path, message_id, channel_id).

    ``messages`` carries ``message_id, channel_id, message_posted_at,
    has_photo``; ``existing_images`` has the ``image_path`` of files already
    stored.  The path is ``images/<date>/<id>.jpg`` with no channel in it, so
    two channels posting the same id on the same day share one path: the
    lowest channel id claims it and the other is skipped, as an existing file
    would be.
    """
    photos = messages.filter(F.col("has_photo"))
    if channels is not None:
        photos = filter_channels(photos, channels)
    paths = photos.select(
        image_file_path(day_of(F.col("message_posted_at")).cast("string"), F.col("message_id")).alias("image_path"),
        "message_id",
        "channel_id",
    )
    # Grouped by path alone (the id is part of the path), so the anti-join
    # below reuses this partitioning instead of shuffling again.
    claimed = paths.groupBy("image_path").agg(
        F.min("message_id").alias("message_id"), F.min("channel_id").alias("channel_id")
    )
    return claimed.join(existing_images.select("image_path"), "image_path", "left_anti")
