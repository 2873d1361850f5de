"""Report queries: ordering, ILIKE semantics, stop words, lookups."""

import datetime as dt

import pytest

from chanmart.operators import reports as R

SCHEMA = "message_id long, channel_id long, message_posted_at timestamp_ntz, message_text string"


@pytest.fixture(scope="module")
def fct(spark):
    rows = [
        (1, 1, dt.datetime(2024, 1, 1, 9), "Paracetamol 500mg in stock"),
        (2, 1, dt.datetime(2024, 1, 1, 10), "PARACETAMOL and vitamin with http link"),
        (3, 2, None, "paracetamol syrup"),
        (4, 2, dt.datetime(2024, 1, 2, 8), "100% cotton masks"),
        (5, 1, dt.datetime(2024, 1, 3, 8), None),
        (6, 2, dt.datetime(2024, 1, 2, 9), "  vitamin\tvitamin\nsyrup  "),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_search_is_case_insensitive_newest_first_nulls_first(fct):
    got = [r["message_id"] for r in R.search_messages(fct, "paracetamol").collect()]
    assert got == [3, 2, 1]
    assert [r["message_id"] for r in R.search_messages(fct, "paracetamol", limit=2).collect()] == [3, 2]


def test_search_keeps_like_wildcards(fct):
    assert [r["message_id"] for r in R.search_messages(fct, "100%").collect()] == [4]
    assert [r["message_id"] for r in R.search_messages(fct, "s_rup").collect()] == [3, 6]


def test_top_products(fct):
    got = [tuple(r) for r in R.top_products(fct, limit=3).collect()]
    assert got == [("paracetamol", 3), ("vitamin", 3), ("syrup", 2)]
    words = {r["product_name"] for r in R.product_mentions(fct).collect()}
    assert "with" not in words and "http" not in words and "and" not in words and "" not in words


def test_channel_activity(fct):
    got = [tuple(r) for r in R.channel_activity(fct, 2).collect()]
    assert got == [("2024-01-02", 2), (None, 1)]


def test_channel_lookup(spark, fct):
    dim = spark.createDataFrame([(1, "Channel 1"), (2, "Channel 2")], "channel_id long, channel_name string")
    assert [r[0] for r in R.channel_id_by_name(dim, "Channel 2").collect()] == [2]
    assert R.channel_id_by_name(dim, "nope").count() == 0
    assert [tuple(r) for r in R.channel_activity_by_name(fct, dim, "Channel 1").collect()] == [
        ("2024-01-01", 2),
        ("2024-01-03", 1),
    ]
    assert [tuple(r) for r in R.channel_activity_for_name(fct, dim, "Channel 1").collect()] == [
        ("2024-01-01", 2),
        ("2024-01-03", 1),
    ]
    with pytest.raises(KeyError):
        R.channel_activity_by_name(fct, dim, "Channel 9")
    dim3 = spark.createDataFrame([(3, "Channel 3")], "channel_id long, channel_name string")
    assert R.channel_activity_by_name(fct, dim3, "Channel 3").count() == 0


def test_top_detected_objects(spark):
    det = spark.createDataFrame(
        [(1, "pill"), (2, "pill"), (3, "bottle"), (None, "box"), (5, "box"), (6, "cup")],
        "detection_id long, detected_object_class string",
    )
    got = [tuple(r) for r in R.top_detected_objects(det, limit=3).collect()]
    assert got == [("pill", 2), ("bottle", 1), ("box", 1)]
