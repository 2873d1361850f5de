"""Queries over the generated test tables, one per operator family.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame built
from the whole input tables through the test-table adapter
(``chanmart.sources.fixtures``): raw message files are validated, loaded,
staged and modelled exactly as a lake would be.

Parameters that a caller would pass (the "as of" date, a search term, a
channel) are fixed here so the results are reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanmart.operators import checks as C
from chanmart.operators import enrich as E
from chanmart.operators import ingest as I
from chanmart.operators import lake_rules as L
from chanmart.operators import reports as R
from chanmart.plans import check_state as CI
from chanmart.plans import jobs as P
from chanmart.plans import marts as M
from chanmart.plans import search_index as SI
from chanmart.plans import staging as S
from chanmart.plans import top_words as TW
from chanmart.session import importable_in_workers, session_conf, shared_folder
from chanmart.sources import fixtures as FX
from chanmart.sources import lake as LK
from chanmart.sources import tables as TB
from chanmart.streaming.ingest_stream import ingest_stream

# Query parameters shared with the SQL oracles.
AS_OF = "2024-01-20"
# Past the five-year end of the date spine.
AS_OF_FULL = "2030-06-30"
SEARCH_TERM = "the"
# Means t_e%ar: a backslash before a plain character stands for that character.
# In few days' messages only.
RARE_TERM = "than%OUEN"
WILDCARD_TERM = "t_e%\\ar"
ALLOWED_CHANNELS = (1002, 1005, 1011)
CHANNEL_ID = 1003
CHANNEL_NAME = "Channel 1007"
LATEST_N = 25
# The previous daily run loaded everything dated before this day.
PREVIOUS_RUN_BEFORE = "2024-01-15"
# Photos dated before this day were already downloaded.
IMAGES_STORED_BEFORE = "2024-01-10"
# The previous detector run reported only classes below this name; this run
# reports every box again, and boxes of classes from this one on twice.
PREVIOUS_DETECTOR_CLASSES_BELOW = "class_5"
REPEATED_CLASSES_FROM = "class_8"


# --- shared building blocks -------------------------------------------------


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.classify_messages(FX.message_files(spark, sf_dir))


def _file_date(path_col: str = "file_path"):
    return F.regexp_extract(F.col(path_col), r"telegram_messages/(\d{4}-\d{2}-\d{2})/", 1)


def _raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.with_load_metadata(I.valid_messages(_classified(spark, sf_dir)))


def _stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stg_telegram_messages(_raw_messages(spark, sf_dir))


# Parsing costs far more than reading: by its default Spark merges shuffled parts until there is hardly one a core.
SMALL_SHARES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m"}


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the session's checkpoint folder, for plans that read it several times."""
    path = shared_folder(spark, name)
    with session_conf(spark, SMALL_SHARES):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _stg_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, _stg(spark, sf_dir), "registered-staging")


def _marts(spark: SparkSession, sf_dir: str):
    stg = _stg_written(spark, sf_dir)
    dates = M.dim_dates(stg, AS_OF)
    fct = M.fct_messages(stg, dates)
    return stg, dates, fct


def _fct_by_lake_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message facts carrying the lake-date partition column, as the pipeline writes them."""
    raw = _raw_messages(spark, sf_dir).withColumn("lake_date", LK.lake_date(F.col("file_path")))
    stg = _written(spark, S.stg_telegram_messages(raw, carry=["lake_date"]), "registered-staging")
    return M.fct_messages(stg, M.dim_dates(stg, AS_OF), carry=["lake_date"])


def _stg_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stg_image_detections(FX.raw_image_detections(spark, sf_dir))


def _fct_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, fct = _marts(spark, sf_dir)
    return M.fct_image_detections(_stg_detections(spark, sf_dir), fct)


def _double_confidence(df: DataFrame) -> DataFrame:
    return df.withColumn("confidence_score", F.col("confidence_score").cast("double"))


# --- registered queries ------------------------------------------------------


def stg_messages(spark, sf_dir):
    return _stg(spark, sf_dir).drop("loaded_at")


def json_reject_missing_id(spark, sf_dir):
    rejects = I.rejected_messages(_classified(spark, sf_dir))
    return rejects.filter(F.col("reject_reason") == "missing_id").select("file_path", "reject_reason")


def dim_channels(spark, sf_dir):
    return M.dim_channels(_stg(spark, sf_dir))


def dim_dates(spark, sf_dir):
    return M.dim_dates(_stg(spark, sf_dir), AS_OF)


def fct_messages(spark, sf_dir):
    return _marts(spark, sf_dir)[2]


def stg_detections(spark, sf_dir):
    return _double_confidence(_stg_detections(spark, sf_dir).drop("loaded_at"))


def fct_image_detections(spark, sf_dir):
    return _double_confidence(_fct_detections(spark, sf_dir))


def search_messages(spark, sf_dir):
    return R.search_messages(_marts(spark, sf_dir)[2], SEARCH_TERM)


def search_messages_wildcard(spark, sf_dir):
    return R.search_messages(_marts(spark, sf_dir)[2], WILDCARD_TERM)


def dim_dates_full(spark, sf_dir):
    return M.dim_dates(_stg(spark, sf_dir), AS_OF_FULL)


def json_reject_reasons(spark, sf_dir):
    """Every reject reason: faults planted in the message files by message number, found by the loader's rules."""
    rejects = I.rejected_messages(I.classify_messages(FX.faulty_message_files(spark, sf_dir)))
    return rejects.select("file_path", "reject_reason")


def filter_channels(spark, sf_dir):
    stg = _written(spark, _stg(spark, sf_dir).select("message_id", "channel_id"), "registered-staging")
    nations = FX.read_input(spark, sf_dir, "nation").filter("n_regionkey = 1")
    frame = nations.select((F.col("n_nationkey") + FX.CHANNEL_BASE).cast("long").alias("allowed"))
    by_list = L.filter_channels(stg, ALLOWED_CHANNELS).withColumn("allowed_by", F.lit("list"))
    return by_list.unionByName(L.filter_channels(stg, frame).withColumn("allowed_by", F.lit("frame")))


def image_message_id(spark, sf_dir):
    images = FX.dated_image_files(spark, sf_dir)
    return images.select("image_path", E.image_message_id(F.col("image_path")).alias("message_id"))


def top_products(spark, sf_dir):
    return R.top_products(_marts(spark, sf_dir)[2])


def product_mentions(spark, sf_dir):
    return R.product_mentions(_marts(spark, sf_dir)[2])


def top_products_rollup(spark, sf_dir):
    return R.top_products_from_rollup(R.word_count_rollup(_fct_by_lake_date(spark, sf_dir)))


def channel_activity_rollup(spark, sf_dir):
    return R.channel_activity_from_rollup(R.channel_day_rollup(_fct_by_lake_date(spark, sf_dir)), CHANNEL_ID)


def channel_activity(spark, sf_dir):
    return R.channel_activity(_marts(spark, sf_dir)[2], CHANNEL_ID)


def channel_activity_by_name(spark, sf_dir):
    stg, _, fct = _marts(spark, sf_dir)
    return R.channel_activity_for_name(fct, M.dim_channels(stg), CHANNEL_NAME)


def channel_id_by_name(spark, sf_dir):
    return R.channel_id_by_name(M.dim_channels(_stg(spark, sf_dir)), CHANNEL_NAME)


def top_detected_objects(spark, sf_dir):
    return R.top_detected_objects(_fct_detections(spark, sf_dir))


def latest_per_channel(spark, sf_dir):
    latest = L.latest_per_channel(_stg(spark, sf_dir), n=LATEST_N)
    return latest.select("channel_id", "message_id", "message_posted_at")


def photo_worklist(spark, sf_dir):
    columns = ["message_id", "channel_id", "message_posted_at", "has_photo"]
    stg = _written(spark, _stg(spark, sf_dir).select(*columns), "registered-staging")
    stored = L.photo_worklist(
        stg.filter(F.col("message_posted_at") < F.lit(IMAGES_STORED_BEFORE).cast("timestamp_ntz")),
        spark.createDataFrame([], "image_path string"),
    )
    return L.photo_worklist(stg, stored, channels=M.dim_channels(stg))


def append_new_messages(spark, sf_dir):
    incoming = I.valid_messages(_classified(spark, sf_dir))
    existing = incoming.filter(_file_date() < F.lit(PREVIOUS_RUN_BEFORE))
    return I.append_new_messages(existing, incoming).select("file_path", "message_id", "channel_id")


def append_new_detections(spark, sf_dir):
    detected = FX.raw_image_detections(spark, sf_dir)
    cls = F.col("detected_object_class")
    existing = detected.filter(cls < F.lit(PREVIOUS_DETECTOR_CLASSES_BELOW))
    incoming = detected.unionByName(detected.filter(cls >= F.lit(REPEATED_CLASSES_FROM)))
    new = E.append_new_detections(existing, incoming)
    return _double_confidence(
        new.select("id", "message_id", "image_path", "detected_object_class", "confidence_score", "bounding_box")
    )


def unprocessed_images(spark, sf_dir):
    return E.unprocessed_images(FX.image_files(spark, sf_dir), FX.raw_image_detections(spark, sf_dir))


def check_unique(spark, sf_dir):
    return C.check_unique(_fct_detections(spark, sf_dir), "message_id")


def check_not_null(spark, sf_dir):
    return C.check_not_null(_marts(spark, sf_dir)[2], "date_day").select(
        "message_id", "channel_id", "message_posted_at"
    )


def check_relationship(spark, sf_dir):
    _, _, fct = _marts(spark, sf_dir)
    fdet = M.fct_image_detections(_stg_detections(spark, sf_dir), fct)
    return C.check_relationship(fdet, "message_id", fct, "message_id").select("detection_id", "message_id")


def run_checks(spark, sf_dir):
    stg, _, fct = _marts(spark, sf_dir)
    fdet = M.fct_image_detections(_stg_detections(spark, sf_dir), fct)
    return C.run_checks(fct, M.dim_channels(stg), fdet)


def ingest_stats(spark, sf_dir):
    classified = _classified(spark, sf_dir)
    existing = I.valid_messages(classified).filter(_file_date() < F.lit(PREVIOUS_RUN_BEFORE))
    return I.ingest_stats(classified, existing)


# --- whole jobs: landed, loaded, built and read back -----------------------------
# These write a lake or a warehouse under the session's shared checkpoint folder,
# run the jobs over it, and return what is in it then.


def _photo_files(spark, sf_dir):
    """(file_path, value): the photo messages' image files, whose bytes tell a stand-in detector what is to be seen."""
    m = FX.message_events(spark, sf_dir).filter(F.col("event_type").isin(*FX.PHOTO_EVENTS))
    e = FX.read_input(spark, sf_dir, "embeddings")
    numbers = F.transform(F.slice("embedding", 1, 5), lambda x: F.floor(x * 1000).cast("string"))
    boxes = e.select(F.expr("vec_id DIV 2").alias("doc_id"), F.concat_ws(" ", "label", F.array_join(numbers, " ")).alias("box"))
    seen = boxes.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list("box")), "\n").alias("boxes"))
    spoilt = F.col("doc_id") % SPOILT_EVERY == 3
    text = F.when(spoilt, "BAD").otherwise(F.coalesce("boxes", F.lit("")))
    return m.join(seen, "doc_id", "left").select(LK.image_file_path(F.substring(F.col("ts").cast("string"), 1, 10), F.col("doc_id")).alias("file_path"), text.alias("value"))


# Every so many'th image can't be decoded.
SPOILT_EVERY = 7


def box_reader():
    """A detector that reads its boxes from the image's bytes: class, confidence in thousandths, corners."""

    def detect(path, data):
        if data == b"BAD":
            raise ValueError("cannot decode")
        for line in data.decode().splitlines():
            label, confidence, *box = line.split(" ")
            yield f"class_{label}", abs(int(confidence)) % 1000 / 1000, [float(x) for x in box]

    return detect


def enrich_images(spark, sf_dir):
    """S8, F8 to F12, S9: image files landed, listed, dealt to the detector by size, boxes stored once (the second run adds none)."""
    base = shared_folder(spark, "registered-images")
    importable_in_workers(spark)
    LK.write_message_files(_photo_files(spark, sf_dir), base)
    for _ in range(2):
        P.enrich_images(spark, f"{base}/images", f"{base}/warehouse", box_reader)
    boxes = TB.read_table(spark, f"{base}/warehouse", TB.RAW_IMAGE_DETECTIONS)
    return _double_confidence(boxes.select("message_id", "detected_object_class", "confidence_score", "bounding_box"))


def _landing(spark, sf_dir):
    """The message files as rows to land: date, channel folder, id, payload."""
    part = lambda k: F.element_at(F.split("file_path", "/"), k)
    number = F.regexp_extract("file_path", r"/(\d+)\.json$", 1).cast("long")
    return FX.message_files(spark, sf_dir).select(number.alias("message_id"), part(-2).alias("channel"), part(-3).alias("message_date"), F.col("value").alias("payload"))


def land_and_load(spark, sf_dir):
    """S6, S3 to S5: messages landed in two overlapping runs, each once; loaded in two runs, each once."""
    base = shared_folder(spark, "registered-lake")
    rows = _landing(spark, sf_dir)
    for part in (rows.filter(F.col("message_date") < PREVIOUS_RUN_BEFORE), rows):
        LK.write_partitioned_lake(part, f"{base}/lake")
        P.load_message_batch(spark, LK.read_landed_messages(spark, f"{base}/lake"), f"{base}/warehouse")
    return TB.read_table(spark, f"{base}/warehouse", TB.RAW_MESSAGES).select("file_path", "message_id", "channel_id")


def stream_load(spark, sf_dir):
    """S1, S6, S7: one file a message, found by the date cursor in two runs of the stream."""
    base = shared_folder(spark, "registered-stream")
    importable_in_workers(spark)
    files = FX.message_files(spark, sf_dir)
    for part in (files.filter(_file_date() < PREVIOUS_RUN_BEFORE), files):
        LK.write_message_files(part, f"{base}/lake")
        ingest_stream(spark, f"{base}/lake", f"{base}/warehouse", f"{base}/checkpoint").awaitTermination()
    raw = TB.read_table(spark, f"{base}/warehouse", TB.RAW_MESSAGES)
    return raw.select(F.regexp_extract("file_path", r"(telegram_messages/.*)$", 1).alias("file_path"), "message_id", "channel_id", "lake_date")


def _built_in_two_runs(spark, sf_dir):
    """A warehouse loaded, enriched and built up to one day, checked, then the same with the rest."""
    root = shared_folder(spark, "registered-warehouse")
    files, boxes = FX.message_files(spark, sf_dir), FX.raw_image_detections(spark, sf_dir)
    early = F.col("id") % 3 == 0
    for messages, detections, as_of in ((files.filter(_file_date() < PREVIOUS_RUN_BEFORE), boxes.filter(early), PREVIOUS_RUN_BEFORE), (files, boxes.filter(~early), AS_OF)):
        P.load_message_batch(spark, messages, root)
        TB.write_table(detections, root, TB.RAW_IMAGE_DETECTIONS, "append", ["image_date"])
        P.build_marts(spark, root, as_of)
        checks = CI.run_checks_incremental(spark, root)
    return root, checks


def fct_image_detections_incremental(spark, sf_dir):
    root, _ = _built_in_two_runs(spark, sf_dir)
    return _double_confidence(TB.read_table(spark, root, TB.FCT_IMAGE_DETECTIONS).drop("bucket"))


def run_checks_incremental(spark, sf_dir):
    return _built_in_two_runs(spark, sf_dir)[1]


def top_products_bounded(spark, sf_dir):
    """Word counts by lake date, merged by ten days, asked from their heads."""
    root = shared_folder(spark, "registered-words")
    counts = R.word_count_rollup(_fct_by_lake_date(spark, sf_dir))
    TB.write_table(counts, root, TB.RPT_WORD_COUNTS, partition_by=["lake_date"], sort_by=[F.col("mention_count").desc()])
    TW.build_period_counts(spark, root, period=len("2024-01-1"))
    return TW.top_products_bounded(spark, root)


def search_messages_indexed(spark, sf_dir):
    """The facts written by lake date, indexed, and searched through the index."""
    root = shared_folder(spark, "registered-search")
    TB.write_table(_fct_by_lake_date(spark, sf_dir), root, TB.FCT_MESSAGES, partition_by=["lake_date"])
    SI.build_search_index(spark, root)
    return SI.search_messages_indexed(spark, root, RARE_TERM)


QUERIES = {
    "stg_messages": stg_messages,
    "json_reject_missing_id": json_reject_missing_id,
    "dim_channels": dim_channels,
    "dim_dates": dim_dates,
    "fct_messages": fct_messages,
    "stg_detections": stg_detections,
    "fct_image_detections": fct_image_detections,
    "search_messages": search_messages,
    "search_messages_wildcard": search_messages_wildcard,
    "dim_dates_full": dim_dates_full,
    "json_reject_reasons": json_reject_reasons,
    "filter_channels": filter_channels,
    "image_message_id": image_message_id,
    "top_products": top_products,
    "product_mentions": product_mentions,
    "top_products_rollup": top_products_rollup,
    "channel_activity_rollup": channel_activity_rollup,
    "channel_activity": channel_activity,
    "channel_activity_by_name": channel_activity_by_name,
    "channel_id_by_name": channel_id_by_name,
    "top_detected_objects": top_detected_objects,
    "latest_per_channel": latest_per_channel,
    "photo_worklist": photo_worklist,
    "append_new_messages": append_new_messages,
    "append_new_detections": append_new_detections,
    "unprocessed_images": unprocessed_images,
    "check_unique": check_unique,
    "check_not_null": check_not_null,
    "check_relationship": check_relationship,
    "run_checks": run_checks,
    "ingest_stats": ingest_stats,
    "enrich_images": enrich_images,
    "land_and_load": land_and_load,
    "stream_load": stream_load,
    "fct_image_detections_incremental": fct_image_detections_incremental,
    "run_checks_incremental": run_checks_incremental,
    "search_messages_indexed": search_messages_indexed,
    "top_products_bounded": top_products_bounded,
}
