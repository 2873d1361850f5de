"""Mart models: channel and date dimensions, message and detection facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanmart.functions import dates as D
from chanmart.functions.text import char_length

# Fixed value: placeholder channel names are 'Channel <id>'.
CHANNEL_NAME_PREFIX = "Channel "


def dim_channels(stg_messages: DataFrame) -> DataFrame:
    """Distinct non-NULL channels with a placeholder name.

    ``distinct`` runs as a partial (map-side) then final aggregation, so a
    channel holding most messages collapses to one row before the shuffle.
    """
    channels = stg_messages.filter(F.col("channel_id").isNotNull()).select("channel_id").distinct()
    return channels.select(
        "channel_id",
        F.concat(F.lit(CHANNEL_NAME_PREFIX), F.col("channel_id").cast("string")).alias("channel_name"),
    )


def first_day(stg_messages: DataFrame) -> DataFrame:
    """One row, ``_d0``: the earliest message day (partial + final min aggregate)."""
    return stg_messages.agg(F.min(D.day_of(F.col("message_posted_at"))).alias("_d0"))


def date_spine(first: DataFrame, as_of=None) -> DataFrame:
    """The date dimension from a one-row ``_d0`` frame (see ``dim_dates``)."""
    bound = D.as_of_date(as_of)
    d0 = F.col("_d0")
    # Filter before building the sequence: an inverted range would raise.
    spine = first.filter(d0 <= bound).select(
        F.explode(F.sequence(d0, F.least(F.date_add(d0, D.SPINE_DAYS), bound))).alias("date_day")
    )
    return spine.select("date_day", *D.date_attributes(F.col("date_day")))


def dim_dates(stg_messages: DataFrame, as_of=None) -> DataFrame:
    """One row per day from the first message's day to ``as_of`` (default today).

    The spine holds at most 365*5 + 1 days: day 0 is the first message's
    date.  Empty when there are no dated messages or the first one is after
    ``as_of``.  The global minimum is a partial+final aggregate; the spine is
    generated from that single row, so the dimension never grows with the data.
    """
    return date_spine(first_day(stg_messages), as_of)


def fct_messages(stg_messages: DataFrame, dates: DataFrame, carry=()) -> DataFrame:
    """Messages with their date key; a message outside the spine keeps a NULL date.

    The date dimension is bounded (at most 1,826 rows, see ``dim_dates``), so it
    is broadcast: the message side is never shuffled for this join.  ``carry``
    names extra input columns to keep (e.g. a partition column).
    """
    days = F.broadcast(dates.select("date_day"))
    msgs = stg_messages.withColumn("_day", D.day_of(F.col("message_posted_at")))
    joined = msgs.join(days, msgs["_day"] == days["date_day"], "left")
    return joined.select(
        "message_id",
        "channel_id",
        "date_day",
        "message_text",
        char_length(F.col("message_text")).alias("message_length"),
        "view_count",
        "has_photo",
        "message_posted_at",
        *carry,
    )


def message_keys(stg_messages: DataFrame) -> DataFrame:
    """What detections need of a message: id, channel and day.  A row never changes, so this table only grows."""
    return stg_messages.select("message_id", "channel_id", D.day_of(F.col("message_posted_at")).alias("posted_day"))


def dated_keys(keys: DataFrame, spine) -> DataFrame:
    """``message_keys`` with their date key: the day where it lies in ``spine`` (first, last), else NULL."""
    day = F.col("posted_day")
    inside = day.between(F.lit(spine[0]), F.lit(spine[1])) if spine else F.lit(False)
    return keys.select("message_id", "channel_id", F.when(inside, day).alias("date_day"))


def fct_image_detections(stg_detections: DataFrame, messages: DataFrame, carry=()) -> DataFrame:
    """One row per detected box with its message's channel and date.

    Left join on ``message_id`` only.  Both sides grow with the data, so no
    broadcast is forced; the planner (with AQE) picks one only from measured
    sizes, and skewed message ids on the detection side are split by AQE's
    skew-join handling.  Sides laid out by hash of the id are not shuffled.
    """
    m = messages.select("message_id", "channel_id", "date_day")
    joined = stg_detections.join(m, "message_id", "left")
    return joined.select(
        "detection_id",
        "message_id",
        "channel_id",
        "date_day",
        "detected_object_class",
        "confidence_score",
        "bounding_box",
        "image_path",
        *carry,
    )
