"""Adapter from the generated test tables to this warehouse's raw inputs.

An event is a message: it gives the post time, the sender and the media
type; the document with the same number gives text, length and channel
(``srcN``: id 1000 + N).  An event without a document is a message without
text (a service message), in channel ``user_id % 20``.  Each becomes the JSON
text of one message file at
``telegram_messages/<date>/<channel>/<id>.json``.  Embedding rows are
detector boxes: row ``v`` is a box of message ``v DIV 2``.

Every frame here is derived by Spark from the given tables, so the work
grows with them; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanmart.sources.lake import image_file_path
from chanmart.sources.tables import read_input

# Event types that mean "photo attached" / "web page attached",
# and the one that means "no sender".
PHOTO_EVENTS = ("view", "purchase")
WEBPAGE_EVENTS = ("click",)
NO_SENDER_EVENT = "error"
CHANNEL_BASE = 1000
SERVICE_CHANNELS = 20


def channel_of_source(source):
    return F.lit(CHANNEL_BASE) + F.substring(source, 4, 1 << 20).cast("bigint")


def _ts_text(ts, n: int):
    # substr of the NTZ text, not date_format: no session time zone involved.
    return F.substring(ts.cast("string"), 1, n)


def message_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its document's fields (NULL text without one)."""
    docs = read_input(spark, sf_dir, "documents").select(F.col("doc_id").alias("event_id"), "text", "source", "n_chars")
    events = read_input(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    joined = events.join(docs, "event_id", "left")
    service = F.concat(F.lit("src"), (F.col("user_id") % SERVICE_CHANNELS).cast("string"))
    return joined.withColumnRenamed("event_id", "doc_id").withColumn("source", F.coalesce("source", service))


def message_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_path, value): one raw message file per event, as the lake holds them."""
    m = message_events(spark, sf_dir)
    channel = channel_of_source(m.source)
    payload = F.struct(
        F.lit("Message").alias("_"),
        m.doc_id.alias("id"),
        F.struct(F.lit("PeerChannel").alias("_"), channel.alias("channel_id")).alias("peer_id"),
        F.concat(_ts_text(m.ts, 19), F.lit("+00:00")).alias("date"),
        m.text.alias("message"),
        m.n_chars.alias("views"),
        F.when(
            m.event_type != NO_SENDER_EVENT,
            F.struct(F.lit("PeerUser").alias("_"), m.user_id.alias("user_id")),
        ).alias("from_id"),
        F.when(m.event_type.isin(*PHOTO_EVENTS), F.struct(F.lit("MessageMediaPhoto").alias("_")))
        .when(m.event_type.isin(*WEBPAGE_EVENTS), F.struct(F.lit("MessageMediaWebPage").alias("_")))
        .alias("media"),
    )
    path = F.concat_ws(
        "/", F.lit("telegram_messages"), _ts_text(m.ts, 10), m.source, F.concat(m.doc_id.cast("string"), F.lit(".json"))
    )
    return m.select(path.alias("file_path"), F.to_json(payload).alias("value"))


def raw_image_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enrichment table as a detector run would have left it."""
    e = read_input(spark, sf_dir, "embeddings")
    return e.select(
        (e.vec_id + 1).alias("id"),
        F.expr("vec_id DIV 2").alias("message_id"),
        F.concat(F.lit("images/"), F.expr("vec_id DIV 2").cast("string"), F.lit(".jpg")).alias("image_path"),
        F.concat(F.lit("class_"), e.label.cast("string")).alias("detected_object_class"),
        F.abs(e.embedding[0]).cast("float").alias("confidence_score"),
        F.transform(F.slice(e.embedding, 1, 4), lambda x: x.cast("double")).alias("bounding_box"),
        F.lit(None).cast("timestamp").alias("loaded_at"),
        F.lit("undated").alias("image_date"),
    )


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path): image files present in the image store, one per photo message."""
    m = message_events(spark, sf_dir)
    return m.filter(m.event_type.isin(*PHOTO_EVENTS)).select(
        F.concat(F.lit("images/"), m.doc_id.cast("string"), F.lit(".jpg")).alias("path")
    )


def faulty_message_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message files with one fault each, by message number modulo 12; 0, 10 and 11 stay loadable.

    0 has a repeated key, whose last value counts; 11 a number with a fraction where the staging model wants an integer.
    """
    files = message_files(spark, sf_dir)
    number = F.regexp_extract("file_path", r"/(\d+)\.json$", 1).cast("bigint")
    value = F.col("value")
    own_id = F.concat(F.lit('"id":'), number.cast("string"), F.lit(","))
    rest = F.expr("substring(value, 2)")
    broken = {
        0: F.concat(F.lit('{"id":1.5,"peer_id":7,'), rest),
        1: F.concat(value, F.lit(' {"id":1}')),
        2: F.concat(F.lit("["), value, F.lit("]")),
        3: F.replace(value, F.lit('"peer_id":{'), F.lit('"peer_id":"x","peer":{')),
        4: F.replace(value, own_id, F.lit('"id":0,')),
        5: F.replace(value, own_id, F.lit('"id":1.5,')),
        6: F.regexp_replace(value, r'"channel_id":\d+', '"channel_id":"abc"'),
        7: F.concat(F.lit('{"x":"a\\u0000",'), rest),
        8: F.concat(F.lit('{"x":"\\ud83d\\\\\\ude00",'), rest),
        9: F.expr("substring(value, 1, length(value) - 1)"),
        10: F.concat(F.lit('{"x":"\\ud83d\\ude00 \\\\ud83d",'), rest),
        11: F.concat(F.lit('{"views":1.0,'), F.replace(rest, F.lit('"views":'), F.lit('"seen":'))),
    }
    fault = F.pmod(number, F.lit(12))
    planted = value
    for k, text in broken.items():
        planted = F.when(fault == k, text).otherwise(planted)
    return files.select("file_path", planted.alias("value"))


def dated_image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_path): the photo messages' files in the lake's layout, every seventh with a name that is no number."""
    m = message_events(spark, sf_dir).filter(F.col("event_type").isin(*PHOTO_EVENTS))
    stem = F.concat(F.when(F.col("doc_id") % 7 == 3, "cover_").otherwise(""), F.col("doc_id").cast("string"))
    return m.select(image_file_path(_ts_text(m.ts, 10), stem).alias("image_path"))
