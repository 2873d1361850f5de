"""Data checks on frames with planted faults."""

import pytest

from chanmart.operators import checks as C


@pytest.fixture(scope="module")
def tables(spark):
    fct = spark.createDataFrame(
        [(1, 10), (1, 10), (2, None), (None, 11), (3, 99)], "message_id long, channel_id long"
    )
    dim = spark.createDataFrame([(10, "Channel 10"), (11, "Channel 11"), (11, "x")], "channel_id long, channel_name string")
    det = spark.createDataFrame([(1, 1), (2, 2), (2, 7), (None, None)], "detection_id long, message_id long")
    return fct, dim, det


def test_unique(tables):
    fct, _, _ = tables
    assert [tuple(r) for r in C.check_unique(fct, "message_id").collect()] == [(1, 2)]


def test_not_null(tables):
    fct, _, _ = tables
    assert C.check_not_null(fct, "channel_id").count() == 1


def test_relationship(tables):
    fct, dim, det = tables
    assert [r["message_id"] for r in C.check_relationship(fct, "channel_id", dim, "channel_id").collect()] == [3]
    assert [r["message_id"] for r in C.check_relationship(det, "message_id", fct, "message_id").collect()] == [7]


def test_run_checks(tables):
    fct, dim, det = tables
    got = {(r["table_name"], r["column_name"], r["check_name"]): (r["failures"], r["passed"]) for r in C.run_checks(fct, dim, det).collect()}
    assert got == {
        ("fct_messages", "message_id", "unique"): (1, False),
        ("fct_messages", "message_id", "not_null"): (1, False),
        ("fct_messages", "channel_id", "not_null"): (1, False),
        ("fct_messages", "channel_id", "relationships"): (1, False),
        ("dim_channels", "channel_id", "unique"): (1, False),
        ("dim_channels", "channel_id", "not_null"): (0, True),
        ("fct_image_detections", "detection_id", "unique"): (1, False),
        ("fct_image_detections", "detection_id", "not_null"): (1, False),
        ("fct_image_detections", "message_id", "not_null"): (1, False),
        ("fct_image_detections", "message_id", "relationships"): (1, False),
    }


def test_relationship_hot_key_counts_all_rows(spark):
    boxes = spark.range(3000).selectExpr("id AS detection_id", "IF(id % 3 = 0, 42, id) AS message_id")
    fct = spark.range(1, 3000).selectExpr("id AS message_id", "1L AS channel_id").filter("message_id <> 42")
    dim = spark.range(1, 2).selectExpr("id AS channel_id")
    lost = C.run_checks(fct, dim, boxes).filter("check_name = 'relationships' AND table_name = 'fct_image_detections'").first()
    assert lost["failures"] == 1000
