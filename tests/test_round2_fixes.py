"""Edges found in review: backslash in a search, hot keys in the relationship check, file age."""

from pyspark.sql import functions as F

from chanmart.functions.text import contains_ci
from chanmart.operators.checks import check_relationship
from chanmart.streaming.ingest_stream import message_file_stream


def test_search_takes_a_backslash(spark):
    df = spark.createDataFrame([("C:temp",), ("C:\\temp",), ("50%",), ("a_b",), ("axb",)], "t string")
    hits = lambda q: {r["t"] for r in df.filter(contains_ci(F.col("t"), q)).collect()}
    assert hits("C:\\temp") == {"C:temp"}
    assert hits("C:\\\\temp") == {"C:\\temp"}
    assert hits("0\\%") == {"50%"}
    assert hits("a\\_b") == {"a_b"} and hits("a_b") == {"a_b", "axb"}


def test_relationship_check_has_no_aggregate_below_the_join(spark):
    child = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id long, k long")
    parent = spark.createDataFrame([(5,), (5,)], "k long")
    found = check_relationship(child, "k", parent, "k")
    assert [r["id"] for r in found.collect()] == [2]
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_streams_do_not_drop_old_files(spark, scratch):
    import os

    os.makedirs(f"{scratch}/lake/telegram_messages/2024-01-01/c")
    paths = [f"{scratch}/lake/telegram_messages/2024-01-01/c/{i}.json" for i in (1, 2)]
    for p in paths:
        with open(p, "w") as f:
            f.write('{"id": 1, "peer_id": {"channel_id": 2}, "date": "2024-01-01 00:00:00+00:00"}')
    os.utime(paths[0], (1_000_000_000, 1_000_000_000))
    q = message_file_stream(spark, f"{scratch}/lake").writeStream.format("memory").queryName("aged").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("aged").count() == 2


def test_changed_days_reach_the_scan(spark, scratch):
    import datetime as dt

    from chanmart.plans.jobs import _days_changed

    days = [dt.datetime(2024, 1, d, 12) for d in range(1, 11)]
    spark.createDataFrame([(d,) for d in days], "message_posted_at timestamp_ntz").write.parquet(f"{scratch}/t")
    table = spark.read.parquet(f"{scratch}/t")
    day = lambda d: dt.date(2024, 1, d)
    got = lambda a, b: {r[0].day for r in table.filter(_days_changed(a, b)).collect()}
    assert got((day(1), day(4)), (day(2), day(7))) == {1, 5, 6, 7}
    assert got(None, (day(3), day(4))) == {3, 4} and got((day(1), day(4)), (day(1), day(4))) == set()
    assert got((day(1), day(2)), (day(5), day(6))) == {1, 2, 5, 6}
    plan = table.filter(_days_changed((day(1), day(4)), (day(1), day(5))))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(message_posted_at), GreaterThanOrEqual" in plan


class FailsOnce:
    """Fails on every image until the marker file is there; one box each afterwards."""

    marker = ""

    def __init__(self, marker):
        self.marker = marker

    def __call__(self):
        import os

        def detect(path, data):
            if not os.path.exists(self.marker):
                raise OSError("store timed out")
            return [("box", 0.5, [0, 0, 1, 1])]

        return detect


def test_stream_retries_and_records_failed_images(spark, scratch):
    import os

    from chanmart.sources import tables as TB
    from chanmart.streaming.ingest_stream import enrich_stream

    folder = f"{scratch}/my images/2024-01-01"
    os.makedirs(folder)
    for name in ("7.jpg", "8.jpg", "cover.jpg"):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(b"x")
    marker, root = f"{scratch}/up", f"{scratch}/root"
    run = lambda: enrich_stream(spark, f"{scratch}/my images", root, FailsOnce(marker), f"{scratch}/ck").awaitTermination()
    run()
    failed = TB.read_table(spark, root, TB.RAW_IMAGE_FAILURES).collect()
    assert sorted(r["image_path"].rsplit("/", 1)[1] for r in failed) == ["7.jpg", "8.jpg", "cover.jpg"]
    assert all("store timed out" in r["error"] for r in failed)
    assert TB.read_table(spark, root, TB.RAW_IMAGE_DETECTIONS).count() == 0
    open(marker, "w").close()
    run()
    boxes = TB.read_table(spark, root, TB.RAW_IMAGE_DETECTIONS)
    assert sorted(r["message_id"] for r in boxes.collect()) == [7, 8]
    run()
    assert boxes.count() == 2


def test_partitioned_writes_hold_few_files(spark, scratch):
    import glob

    from chanmart.session import session_conf
    from chanmart.sources import tables as TB

    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    with session_conf(spark, conf):
        df = spark.range(0, 200_000, 1, 40).select(F.expr("IF(id % 3 > 0, 'hot', concat('d', id % 5))").alias("lake_date"), F.rand(1).alias("x"))
        TB.write_table(df, scratch, "t", partition_by=["lake_date"], sort_by=["x"])
    files = lambda d: len(glob.glob(f"{scratch}/t/*/lake_date={d}/*.parquet"))
    assert files("hot") > 1 and all(files(f"d{i}") <= files("hot") for i in range(5))
    assert sum(files(f"d{i}") for i in range(5)) < 64
