"""Reject reasons for literal message files (one object per file)."""

import json

import pytest

from chanmart.operators import ingest as I

CASES = [
    ('{"id":1,"peer_id":{"channel_id":9}}', None, 1, 9),
    ('{"id":1}', None, 1, None),
    ('{"id":"7","peer_id":{}}', None, 7, None),
    ('{"id":1,"id":3}', None, 3, None),
    ('{"id":"0"}', None, 0, None),
    ('{"id":1,"peer_id":null}', "bad_peer", None, None),
    ('{"id":1,"peer_id":"x"}', "bad_peer", None, None),
    ('{"id":0}', "missing_id", None, None),
    ("{}", "missing_id", None, None),
    ('{"id":null}', "missing_id", None, None),
    ('{"id":""}', "missing_id", None, None),
    ('{"id":false}', "missing_id", None, None),
    ('{"id":[]}', "missing_id", None, None),
    ('{"id":0.0}', "missing_id", None, None),
    ('{"id":1.5}', "bad_id", None, None),
    ('{"id":true}', "bad_id", None, None),
    ('{"id":1.0}', "bad_id", None, None),
    ('{"id":1E0}', "bad_id", None, None),
    ('{"id":-0}', "missing_id", None, None),
    ('{"id":0e7}', "missing_id", None, None),
    ('{"id":01}', "bad_json", None, None),
    ('{"id":1.}', "bad_json", None, None),
    ('{"id":-}', "bad_json", None, None),
    ('{"id":"\\u0001n5"}', "bad_id", None, None),
    ('{"id":12345678901234567890}', "bad_id", None, None),
    ('{"id":"abc"}', "bad_id", None, None),
    ('{"id":[1]}', "bad_id", None, None),
    ('{"id":1,"peer_id":{"channel_id":"x"}}', "bad_channel", None, None),
    ('{"id":1,"peer_id":{"channel_id":1.5}}', "bad_channel", None, None),
    ('{"id":1,"message":"a\\u0000b"}', "nul_char", None, None),
    ('{"id":1,"message":"a\\\\\\u0000b"}', "nul_char", None, None),
    ('{"id":1,"message":"a\\\\u0000b"}', None, 1, None),
    ('{"id":1} garbage', "bad_json", None, None),
    ('{"id":1}]x', "bad_json", None, None),
    ('{"id":1}} x', "bad_json", None, None),
    ('{"id":1},{"id":2}', "bad_json", None, None),
    ('{"id":1},"a":2', "bad_json", None, None),
    (' {"id":1}\n', None, 1, None),
    ('{"id":1,"message":"\\ud83d\\ude00"}', None, 1, None),
    ('{"id":1,"message":"\\\\ud83d"}', None, 1, None),
    ('{"id":1,"message":"\\ud83d x"}', "lone_surrogate", None, None),
    ('{"id":1,"message":"\\ude00\\ud83d"}', "lone_surrogate", None, None),
    ('{"id":1,"message":"\\ud83d\\\\\\ude00"}', "lone_surrogate", None, None),
    ("[1]", "not_object", None, None),
    ("null", "not_object", None, None),
    ("{bad", "bad_json", None, None),
    ("", "bad_json", None, None),
    ('{"id":NaN}', "bad_json", None, None),
]


@pytest.fixture(scope="module")
def classified(spark):
    rows = [(f"f{i}.json", text) for i, (text, *_rest) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "file_path string, value string")
    return {r["file_path"]: r for r in I.classify_messages(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_reason(classified, i):
    text, reason, msg_id, channel = CASES[i]
    row = classified[f"f{i}.json"]
    assert row["reject_reason"] == reason, text
    if reason is None:
        assert row["message_id"] == msg_id
        assert row["channel_id"] == channel


def test_duplicate_keys_last_wins_in_raw_data(classified):
    i = next(i for i, c in enumerate(CASES) if c[0] == '{"id":1,"id":3}')
    assert classified[f"f{i}.json"]["raw_data"] == '{"id":3}'


def test_numbers_are_kept_as_written(spark):
    texts = [
        '{"id":1,"views":1.0,"list":[1,2.50,-3e5,{"c":0}],"s":"x 1.0 \\" 2 \\\\"}',
        '{"id":2,"a":"\\u00011.0","b":"\\u0001n5","c":"\\\\u0001n7","d":"q\\"\\u0001n5\\"","e":"\\u0001\\u0001s"}',
        '{"id":3,"n":123456789012345678901234567890.10,"x":"' + "\\\\" * 50_000 + '"}',
        '{"id":4,"many":[' + ",".join(f'"s{i}"' for i in range(20_000)) + ",1.10]}",
    ]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "file_path string, value string")
    got = {r["file_path"]: r["raw_data"] for r in I.classify_messages(df).collect()}
    for i, t in enumerate(texts):
        as_text = lambda x: json.loads(x, parse_float=str, parse_int=str)
        assert as_text(got[str(i)]) == as_text(t)


def test_split_valid_and_rejects(spark):
    df = spark.createDataFrame([("a.json", '{"id":5}'), ("b.json", "{bad")], "file_path string, value string")
    valid, rejects = I.split_valid_messages(df)
    assert [r["file_path"] for r in valid.collect()] == ["a.json"]
    assert [(r["file_path"], r["reject_reason"], r["raw_text"]) for r in rejects.collect()] == [
        ("b.json", "bad_json", "{bad")
    ]


def test_append_new_messages_loads_each_path_once(spark):
    existing = spark.createDataFrame([("a.json",)], "file_path string")
    incoming = spark.createDataFrame(
        [("a.json", 1), ("b.json", 2), ("b.json", 2), ("c.json", 3)], "file_path string, message_id long"
    )
    new = I.append_new_messages(existing, incoming)
    assert sorted(r["file_path"] for r in new.collect()) == ["b.json", "c.json"]


def test_ingest_stats(spark):
    files = spark.createDataFrame(
        [("a.json", '{"id":1}'), ("b.json", '{"id":2}'), ("c.json", "{bad")], "file_path string, value string"
    )
    existing = spark.createDataFrame([("a.json",)], "file_path string")
    row = I.ingest_stats(I.classify_messages(files), existing).first()
    assert row.asDict() == {"files_seen": 3, "loaded": 1, "already_loaded": 1, "rejected": 1}


def test_with_load_metadata_continues_ids(spark):
    existing = spark.createDataFrame([(7,), (41,)], "id long")
    df = spark.range(5).withColumnRenamed("id", "x").repartition(3)
    ids = sorted(r["id"] for r in I.with_load_metadata(df, existing).collect())
    assert len(set(ids)) == 5 and min(ids) >= 42
