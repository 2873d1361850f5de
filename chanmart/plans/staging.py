"""Staging models: typed columns out of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanmart.functions import json_fields as J

STG_MESSAGE_COLUMNS = (
    "message_id",
    "channel_id",
    "message_posted_at",
    "message_text",
    "view_count",
    "sender_user_id",
    "has_photo",
    "loaded_at",
)


# Where a message's fields lie in its JSON text.
PATHS = {
    "_id": "$.id",
    "_channel": "$.peer_id.channel_id",
    "_date": "$.date",
    "_message": "$.message",
    "_views": "$.views",
    "_sender": "$.from_id.user_id",
    "_media": "$.media._",
}


def stg_telegram_messages(raw_messages: DataFrame, carry=()) -> DataFrame:
    """One typed row per raw message.

    ``raw_data`` is parsed once per row into a variant and every field is
    read from it.  Casts are strict under any ANSI setting: text that is not a number or a
    timestamp fails the build, as the warehouse's casts do.  The ``date``
    text carries an offset; casting to TIMESTAMP_NTZ keeps the wall time and
    drops the offset.  ``has_photo`` is NULL, not false, when media is absent.
    ``carry`` names extra raw columns to keep (e.g. a partition column).
    """
    parsed = J.with_parsed(raw_messages, "raw_data", lenient=False, keep=["loaded_at", *carry])
    texts = J.with_json_texts(parsed, PATHS)
    return texts.select(
        J.strict_cast(F.col("_id"), "bigint").alias("message_id"),
        J.strict_cast(F.col("_channel"), "bigint").alias("channel_id"),
        J.strict_cast(F.col("_date"), "timestamp_ntz").alias("message_posted_at"),
        F.col("_message").alias("message_text"),
        J.strict_cast(F.col("_views"), "int").alias("view_count"),
        J.strict_cast(F.col("_sender"), "bigint").alias("sender_user_id"),
        (F.col("_media") == F.lit(J.PHOTO_MEDIA)).alias("has_photo"),
        "loaded_at",
        *carry,
    )


def stg_image_detections(raw_detections: DataFrame) -> DataFrame:
    """Detections with the surrogate id renamed to ``detection_id``."""
    return raw_detections.select(
        F.col("id").alias("detection_id"),
        "message_id",
        "image_path",
        "detected_object_class",
        "confidence_score",
        "bounding_box",
        "loaded_at",
    )
