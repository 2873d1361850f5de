"""Enrichment operators and lake rules, checked against brute force on small frames."""

import datetime as dt
import random

import pandas as pd

from chanmart.operators import enrich as E
from chanmart.operators import lake_rules as L


def test_image_message_id(spark):
    df = spark.createDataFrame(
        [("file:/x/images/2024-01-01/123.jpg",), ("images/abc.png",), ("images/7.tar.jpeg",), ("images/ 42.jpg",)],
        "p string",
    )
    got = [r[0] for r in df.select(E.image_message_id(df.p)).collect()]
    assert got == [123, None, None, 42]


def test_unprocessed_images(spark):
    images = spark.createDataFrame([("a.jpg",), ("b.jpg",), ("c.jpg",)], "path string")
    det = spark.createDataFrame([("a.jpg",), ("a.jpg",), ("z.jpg",)], "image_path string")
    assert sorted(r[0] for r in E.unprocessed_images(images, det).collect()) == ["b.jpg", "c.jpg"]


SCHEMA = "message_id long, image_path string, detected_object_class string, confidence_score float, bounding_box array<double>"


def test_append_new_detections_null_boxes_never_conflict(spark):
    existing = spark.createDataFrame(
        [(1, "a.jpg", "pill", 0.9, [1.0, 2.0, 3.0, 4.0]), (1, "a.jpg", "pill", 0.8, None)], SCHEMA
    )
    incoming = spark.createDataFrame(
        [
            (1, "a.jpg", "pill", 0.9, [1.0, 2.0, 3.0, 4.0]),  # stored already
            (1, "a.jpg", "pill", 0.7, None),  # NULL box: always new
            (1, "a.jpg", "pill", 0.7, None),
            (1, "a.jpg", "cup", 0.5, [1.0, 2.0, 3.0, 4.0]),
            (1, "a.jpg", "cup", 0.6, [1.0, 2.0, 3.0, 4.0]),  # same key as the row above
            (2, "b.jpg", "pill", 0.9, [1.0, 2.0, 3.0, 4.0]),
        ],
        SCHEMA,
    )
    new = E.append_new_detections(existing, incoming).collect()
    keyed = sorted((r["image_path"], r["detected_object_class"], r["bounding_box"] is None) for r in new)
    assert keyed == [("a.jpg", "cup", False), ("a.jpg", "pill", True), ("a.jpg", "pill", True), ("b.jpg", "pill", False)]


class TwoBoxes:
    def __call__(self, path, data):
        if b"fail" in data:
            raise RuntimeError("boom")
        return [("pill", 0.9, [0, 0, 1, 1]), ("cup", 0.4, [1, 1, 2, 2])] if data else []


def test_detect_objects_isolates_failures(spark):
    images = spark.createDataFrame(
        [("images/1.jpg", bytearray(b"ok")), ("images/2.jpg", bytearray(b"fail")), ("images/3.jpg", bytearray(b""))],
        "path string, content binary",
    )
    out = E.detect_objects(images, TwoBoxes)
    boxes = E.detected_boxes(out).collect()
    assert sorted((r["message_id"], r["detected_object_class"]) for r in boxes) == [(1, "cup"), (1, "pill")]
    assert [r["bounding_box"] for r in boxes if r["detected_object_class"] == "pill"] == [[0.0, 0.0, 1.0, 1.0]]
    errors = E.detection_errors(out).collect()
    assert [(r["image_path"], r["error"].startswith("RuntimeError")) for r in errors] == [("images/2.jpg", True)]
    stats = E.enrichment_stats(E.detected_boxes(out), E.detection_errors(out)).first()
    assert (stats["new_detections"], stats["failed_images"]) == (2, 1)


def test_latest_per_channel_matches_brute_force_with_hot_channel(spark):
    rnd = random.Random(7)
    rows = []
    ids = rnd.sample(range(1, 10**6), 6000)
    for i, mid in enumerate(ids):
        channel = 1 if i % 3 == 0 else rnd.randint(2, 40)  # channel 1 holds a third of the rows
        rows.append((channel, mid))
    df = spark.createDataFrame(rows, "channel_id long, message_id long").repartition(7)
    got = sorted(tuple(r) for r in L.latest_per_channel(df, n=30, fanout=8).collect())
    pdf = pd.DataFrame(rows, columns=["channel_id", "message_id"])
    want = sorted(
        tuple(int(v) for v in x)
        for x in pdf.sort_values("message_id", ascending=False).groupby("channel_id").head(30).itertuples(index=False)
    )
    assert got == want


def test_filter_channels_list_and_frame(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "message_id long, channel_id long")
    assert sorted(r[0] for r in L.filter_channels(df, [10, 30]).collect()) == [1, 3]
    allowed = spark.createDataFrame([(20,), (20,)], "c long")
    assert [r[0] for r in L.filter_channels(df, allowed).collect()] == [2]


def test_photo_worklist(spark):
    msgs = spark.createDataFrame(
        [
            (5, 100, dt.datetime(2024, 1, 1, 9), True),
            (5, 200, dt.datetime(2024, 1, 1, 11), True),  # same id + day in another channel: one path
            (6, 100, dt.datetime(2024, 1, 2, 9), True),
            (7, 100, dt.datetime(2024, 1, 2, 9), False),
            (8, 100, dt.datetime(2024, 1, 3, 9), None),
            (9, 300, dt.datetime(2024, 1, 3, 9), True),
        ],
        "message_id long, channel_id long, message_posted_at timestamp_ntz, has_photo boolean",
    )
    stored = spark.createDataFrame([("images/2024-01-02/6.jpg",)], "image_path string")
    got = sorted(tuple(r) for r in L.photo_worklist(msgs, stored, channels=[100, 200]).collect())
    assert got == [("images/2024-01-01/5.jpg", 5, 100)]
