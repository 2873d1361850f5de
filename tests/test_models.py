"""Staging and mart semantics on literal rows."""

import datetime as dt

import pytest

from chanmart.session import session_conf
from chanmart.plans import marts as M
from chanmart.plans import staging as S


def _raw(spark, docs):
    rows = [(i + 1, d, f"p{i}.json") for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "id long, raw_data string, file_path string").selectExpr(
        "id", "raw_data", "file_path", "CAST(NULL AS TIMESTAMP) AS loaded_at"
    )


def test_staging_fields(spark):
    raw = _raw(
        spark,
        [
            '{"id":5,"peer_id":{"channel_id":9},"date":"2025-07-14 23:10:00+03:00","message":"Hi",'
            '"views":12,"from_id":{"user_id":77},"media":{"_":"MessageMediaPhoto"}}',
            '{"id":6,"date":"2025-07-15 01:00:00+00:00","media":{"_":"MessageMediaWebPage"},"from_id":null}',
            '{"id":"7","media":null}',
        ],
    )
    rows = {r["message_id"]: r for r in S.stg_telegram_messages(raw).collect()}
    a, b, c = rows[5], rows[6], rows[7]
    # The offset is dropped, not applied.
    assert a["message_posted_at"] == dt.datetime(2025, 7, 14, 23, 10)
    assert (a["channel_id"], a["message_text"], a["view_count"], a["sender_user_id"]) == (9, "Hi", 12, 77)
    assert a["has_photo"] is True
    assert b["has_photo"] is False and b["sender_user_id"] is None and b["channel_id"] is None
    # Absent / null media gives NULL, not false.
    assert c["has_photo"] is None and c["message_posted_at"] is None


def test_staging_cast_is_strict(spark):
    raw = _raw(spark, ['{"id":1,"views":"many"}'])
    for ansi in ("true", "false"):
        with session_conf(spark, {"spark.sql.ansi.enabled": ansi}), pytest.raises(Exception, match="not a int: many"):
            S.stg_telegram_messages(raw).collect()


def test_a_number_with_a_fraction_is_no_integer(spark):
    """As ``'1.0'::integer`` fails in the warehouse; text and whole numbers pass as written."""
    ok = S.stg_telegram_messages(_raw(spark, ['{"id":1,"views":10,"message":1.50}', '{"id":"2","message":"\\u0001n7"}'])).collect()
    assert [(r["message_id"], r["view_count"], r["message_text"]) for r in ok] == [(1, 10, "1.50"), (2, None, "\x01n7")]
    for views in ("1.0", "1e0", "12345678901"):
        with pytest.raises(Exception, match="not a int"):
            S.stg_telegram_messages(_raw(spark, [f'{{"id":1,"views":{views}}}'])).collect()


def _stg(spark, rows):
    return spark.createDataFrame(
        rows, "message_id long, channel_id long, message_posted_at timestamp_ntz, message_text string"
    ).selectExpr("*", "CAST(NULL AS INT) AS view_count", "CAST(NULL AS BOOLEAN) AS has_photo")


def test_dim_dates_spine_and_attributes(spark):
    stg = _stg(spark, [(1, 1, dt.datetime(2021, 1, 1, 10), "x"), (2, 1, dt.datetime(2021, 1, 9, 1), "y")])
    rows = M.dim_dates(stg, "2021-01-04").orderBy("date_day").collect()
    assert [r["date_day"] for r in rows] == [dt.date(2021, 1, d) for d in range(1, 5)]
    sun = rows[2]  # 2021-01-03 is a Sunday, ISO week 53 of 2020
    assert (sun["day_of_week"], sun["day_name"], sun["week_of_year"]) == (0, "Sunday   ", 53)
    assert rows[0]["month_name"] == "January  " and rows[0]["quarter_of_year"] == 1


def test_dim_dates_caps_at_five_years(spark):
    stg = _stg(spark, [(1, 1, dt.datetime(2000, 1, 1), "x")])
    assert M.dim_dates(stg, "2030-01-01").count() == 365 * 5 + 1


def test_dim_dates_empty_when_first_message_after_as_of(spark):
    stg = _stg(spark, [(1, 1, dt.datetime(2030, 1, 1), "x")])
    assert M.dim_dates(stg, "2020-01-01").count() == 0
    assert M.dim_dates(_stg(spark, [(1, 1, None, "x")]), "2020-01-01").count() == 0


def test_fct_messages_keeps_rows_outside_spine(spark):
    stg = _stg(
        spark,
        [(1, 1, dt.datetime(2021, 1, 1), "héllo"), (2, 1, dt.datetime(2021, 3, 1), None), (3, None, None, "x")],
    )
    dates = M.dim_dates(stg, "2021-01-31")
    rows = {r["message_id"]: r for r in M.fct_messages(stg, dates).collect()}
    assert rows[1]["date_day"] == dt.date(2021, 1, 1) and rows[1]["message_length"] == 5
    assert rows[2]["date_day"] is None and rows[2]["message_length"] is None
    assert rows[3]["date_day"] is None


def test_dim_channels(spark):
    stg = _stg(spark, [(1, 5, None, ""), (2, 5, None, ""), (3, None, None, ""), (4, 12, None, "")])
    rows = sorted(tuple(r) for r in M.dim_channels(stg).collect())
    assert rows == [(5, "Channel 5"), (12, "Channel 12")]


def test_fct_image_detections_left_join(spark):
    det = spark.createDataFrame(
        [(1, 10, "images/10.jpg", "pill", 0.9, [0.0, 1.0, 2.0, 3.0]), (2, 99, "images/99.jpg", "box", 0.5, None)],
        "detection_id long, message_id long, image_path string, detected_object_class string, "
        "confidence_score float, bounding_box array<double>",
    )
    msgs = spark.createDataFrame([(10, 3, dt.date(2021, 1, 1))], "message_id long, channel_id long, date_day date")
    rows = {r["detection_id"]: r for r in M.fct_image_detections(det, msgs).collect()}
    assert (rows[1]["channel_id"], rows[1]["date_day"]) == (3, dt.date(2021, 1, 1))
    assert rows[2]["channel_id"] is None and rows[2]["message_id"] == 99
