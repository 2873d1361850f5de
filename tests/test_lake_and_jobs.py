"""File tests: a tiny lake in a temp folder, loaded twice (batch and stream), then the full job."""

import json
import os

import pytest

from chanmart.operators import reports as R
from chanmart.plans import jobs as P
from chanmart.session import checkpoint_dir
from chanmart.sources import lake as LK
from chanmart.sources import snapshots as SN
from chanmart.sources import tables as TB
from chanmart.streaming.ingest_stream import enrich_stream, ingest_stream


def _write_msg(lake, date, channel, msg_id, payload=None, raw=None):
    d = os.path.join(lake, "telegram_messages", date, channel)
    os.makedirs(d, exist_ok=True)
    p = os.path.join(d, f"{msg_id}.json")
    with open(p, "w", encoding="utf-8") as f:
        if raw is not None:
            f.write(raw)
        else:
            json.dump(payload, f, ensure_ascii=False, indent=4)
    return p


def _msg(msg_id, channel_id, date, text, photo=False):
    out = {
        "_": "Message",
        "id": msg_id,
        "peer_id": {"_": "PeerChannel", "channel_id": channel_id},
        "date": f"{date} 10:00:00+00:00",
        "message": text,
        "views": 3,
    }
    if photo:
        out["media"] = {"_": "MessageMediaPhoto"}
    return out


@pytest.fixture()
def lake(scratch):
    lake = os.path.join(scratch, "lake")
    _write_msg(lake, "2024-01-01", "chana", 1, _msg(1, 100, "2024-01-01", "Ünïcode paracetamol\nline two"))
    _write_msg(lake, "2024-01-01", "chana", 2, _msg(2, 100, "2024-01-01", "vitamin", photo=True))
    _write_msg(lake, "2024-01-02", "chanb", 1, _msg(1, 200, "2024-01-02", "masks"))
    _write_msg(lake, "2024-01-02", "chanb", 9, raw="{not json")
    with open(os.path.join(lake, "telegram_messages", "notes.txt"), "w") as f:
        f.write("ignored")
    return lake


def test_read_message_files_whole_text(spark, lake):
    rows = LK.read_message_files(spark, lake).collect()
    assert len(rows) == 4
    one = next(r for r in rows if r["file_path"].endswith("chana/1.json"))
    assert json.loads(one["value"])["message"] == "Ünïcode paracetamol\nline two"


def test_batch_load_is_idempotent(spark, lake, scratch):
    root = os.path.join(scratch, "wh")
    first = P.load_messages(spark, lake, root)
    assert first == {"loaded": 3, "already_loaded": 0, "rejected": 1}
    second = P.load_messages(spark, lake, root)
    assert second == {"loaded": 0, "already_loaded": 3, "rejected": 1}
    raw = TB.read_table(spark, root, TB.RAW_MESSAGES)
    assert raw.count() == 3
    assert raw.select("id").distinct().count() == 3
    rejects = TB.read_table(spark, root, TB.RAW_REJECTS).collect()
    # Met on both runs, recorded once.
    assert [(r["reject_reason"], r["lake_date"]) for r in rejects] == [("bad_json", "2024-01-02")]


def test_failed_load_leaves_no_staging_folder(spark, lake, scratch, monkeypatch):
    def fail(*args, **kwargs):
        raise RuntimeError("write refused")

    folder = os.path.join(checkpoint_dir(spark), "chanmart")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    monkeypatch.setattr(TB, "write_table", fail)
    with pytest.raises(RuntimeError, match="write refused"):
        P.load_messages(spark, lake, os.path.join(scratch, "wh"))
    assert set(os.listdir(folder)) <= before


def test_load_gives_the_duplicate_key_setting_back(spark, lake, scratch):
    key = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        assert P.load_messages(spark, lake, os.path.join(scratch, "wh"))["loaded"] == 3
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.set(key, before)


def test_ids_stay_unique_across_loads(spark, lake, scratch):
    root = os.path.join(scratch, "wh")
    P.load_messages(spark, lake, root)
    _write_msg(lake, "2024-01-05", "chana", 7, _msg(7, 100, "2024-01-05", "later"))
    _write_msg(lake, "2024-01-05", "chanb", 8, _msg(8, 200, "2024-01-05", "later too"))
    assert P.load_messages(spark, lake, root) == {"loaded": 2, "already_loaded": 3, "rejected": 1}
    raw = TB.read_table(spark, root, TB.RAW_MESSAGES)
    assert raw.count() == 5 and raw.select("id").distinct().count() == 5
    first = raw.filter("lake_date < '2024-01-05'").agg({"id": "max"}).first()[0]
    later = raw.filter("lake_date = '2024-01-05'").agg({"id": "min"}).first()[0]
    assert later > first
    assert TB.read_next_id(spark, root, TB.RAW_MESSAGES) > raw.agg({"id": "max"}).first()[0]


def test_stream_load_adds_only_new_files(spark, lake, scratch):
    root = os.path.join(scratch, "wh")
    ckpt = os.path.join(scratch, "stream-ckpt")
    ingest_stream(spark, lake, root, ckpt).awaitTermination()
    assert TB.read_table(spark, root, TB.RAW_MESSAGES).count() == 3
    ingest_stream(spark, lake, root, ckpt).awaitTermination()
    assert TB.read_table(spark, root, TB.RAW_MESSAGES).count() == 3
    _write_msg(lake, "2024-01-03", "chana", 3, _msg(3, 100, "2024-01-03", "new one"))
    ingest_stream(spark, lake, root, ckpt).awaitTermination()
    raw = TB.read_table(spark, root, TB.RAW_MESSAGES)
    assert raw.count() == 4
    assert raw.select("file_path").distinct().count() == 4


class BoxDetector:
    """Deterministic stand-in for an object detector: boxes from the file bytes."""

    def __call__(self, path, data):
        if data.startswith(b"BAD"):
            raise ValueError("cannot decode")
        n = data.count(b"x")
        return [("pill" if i % 2 == 0 else "bottle", 0.5 + i / 10, [float(i), 0.0, float(i + 1), 1.0]) for i in range(n)]


def _write_image(image_dir, date, name, content):
    d = os.path.join(image_dir, date)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "wb") as f:
        f.write(content)


def test_full_pipeline(spark, lake, scratch):
    root = os.path.join(scratch, "wh")
    images = os.path.join(scratch, "images")
    _write_image(images, "2024-01-01", "2.jpg", b"xx")
    _write_image(images, "2024-01-01", "1.JPEG", b"x")
    _write_image(images, "2024-01-02", "5.png", b"BAD")
    _write_image(images, "2024-01-02", "cover.jpg", b"x")
    _write_image(images, "2024-01-02", "empty.gif", b"xxxx")
    out = P.run_pipeline(spark, lake, images, root, BoxDetector, as_of="2024-01-01")
    assert out["load"]["loaded"] == 3
    assert out["enrich"] == {"new_detections": 3, "failed_images": 2}
    checks = {(c["table_name"], c["column_name"], c["check_name"]): c["failures"] for c in out["checks"]}
    # message id 1 exists in two channels: the unique test exposes it.
    assert checks[("fct_messages", "message_id", "unique")] == 1
    assert checks[("fct_image_detections", "message_id", "relationships")] == 0
    fct = TB.read_table(spark, root, TB.FCT_MESSAGES)
    assert fct.filter("date_day IS NULL").count() == 1
    det = TB.read_table(spark, root, TB.FCT_IMAGE_DETECTIONS)
    assert det.count() == 4  # message 1's box joins both channels' message 1
    # Re-running enrichment finds nothing new: every successful image has rows.
    again = P.enrich_images(spark, images, root, BoxDetector)
    assert again["new_detections"] == 0


def test_write_partitioned_lake_skips_existing(spark, scratch):
    out = os.path.join(scratch, "landed")
    msgs = spark.createDataFrame(
        [(1, "chana", "2024-01-01", '{"id":1}'), (2, "chana", "2024-01-01", '{"id":2}')],
        "message_id long, channel string, message_date string, payload string",
    )
    LK.write_partitioned_lake(msgs, out)
    more = spark.createDataFrame(
        [(2, "chana", "2024-01-01", '{"id":2}'), (3, "chanb", "2024-01-02", '{"id":3}')],
        "message_id long, channel string, message_date string, payload string",
    )
    written = LK.write_partitioned_lake(more, out, existing=LK.landed_keys(spark, out))
    assert [r["message_id"] for r in written.collect()] == [3]
    got = sorted(r["file_path"] for r in LK.read_landed_messages(spark, out).collect())
    assert got == [
        "telegram_messages/2024-01-01/chana/1.json",
        "telegram_messages/2024-01-01/chana/2.json",
        "telegram_messages/2024-01-02/chanb/3.json",
    ]


def test_landing_knows_what_has_landed(spark, scratch, monkeypatch):
    """By its own key log: the same frame again adds nothing, a writer that dies leaves neither messages nor keys."""
    out = os.path.join(scratch, "landed")
    row = lambda i, day: (i, "chana", day, json.dumps({"id": i}))
    frame = lambda *rows: spark.createDataFrame(list(rows), "message_id long, channel string, message_date string, payload string")
    first = frame(row(1, "2024-01-01"), row(2, "2024-01-01"), row(2, "2024-01-01"), row(3, "2024-01-02"))
    assert LK.write_partitioned_lake(first, out).count() == 3
    assert LK.write_partitioned_lake(first, out).count() == 0
    paths = lambda: sorted(r["file_path"].split("/", 1)[1] for r in LK.read_landed_messages(spark, out).collect())
    three = ["2024-01-01/chana/1.json", "2024-01-01/chana/2.json", "2024-01-02/chana/3.json"]
    assert paths() == three
    more = frame(row(3, "2024-01-02"), row(4, "2024-01-02"))
    with monkeypatch.context() as patch:
        patch.setattr(SN, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            LK.write_partitioned_lake(more, out)
    assert paths() == three and LK.landed_keys(spark, out).count() == 3
    read, own = [], SN.read_snapshot
    monkeypatch.setattr(SN, "read_snapshot", lambda s, r, n, parts=None, **k: read.append(parts) or own(s, r, n, parts, **k))
    assert [r["message_id"] for r in LK.write_partitioned_lake(more, out).collect()] == [4]
    assert read == [["message_date=2024-01-02"]]  # of the log, the batch's date alone
    assert paths() == sorted([*three, "2024-01-02/chana/4.json"])
    assert [r["file_path"][-6:] for r in LK.read_landed_messages(spark, out, ["2024-01-01"]).orderBy("file_path").collect()] == ["1.json", "2.json"]


def test_enrich_stream_processes_new_images_once(spark, scratch):
    root = os.path.join(scratch, "wh")
    images = os.path.join(scratch, "images")
    ckpt = os.path.join(scratch, "enrich-ckpt")
    _write_image(images, "2024-01-01", "2.jpg", b"xx")
    _write_image(images, "2024-01-02", "3.png", b"x")
    enrich_stream(spark, images, root, BoxDetector, ckpt).awaitTermination()
    det = TB.read_table(spark, root, TB.RAW_IMAGE_DETECTIONS)
    assert det.count() == 3
    assert sorted(r["image_date"] for r in det.select("image_date").distinct().collect()) == ["2024-01-01", "2024-01-02"]
    enrich_stream(spark, images, root, BoxDetector, ckpt).awaitTermination()
    assert TB.read_table(spark, root, TB.RAW_IMAGE_DETECTIONS).count() == 3
    _write_image(images, "2024-01-03", "4.jpg", b"xxx")
    enrich_stream(spark, images, root, BoxDetector, ckpt).awaitTermination()
    det = TB.read_table(spark, root, TB.RAW_IMAGE_DETECTIONS)
    assert det.count() == 6 and det.select("id").distinct().count() == 6


def test_write_message_files_lands_each_message_once(spark, scratch):
    lake = os.path.join(scratch, "landed-files")
    files = spark.createDataFrame(
        [
            ("telegram_messages/2024-01-01/chana/1.json", '{"id":1,"message":"é"}'),
            ("telegram_messages/2024-01-02/chanb/2.json", '{"id":2}'),
        ],
        "file_path string, value string",
    )
    assert LK.write_message_files(files, lake) == {"written": 2, "skipped": 0}
    assert LK.write_message_files(files, lake) == {"written": 0, "skipped": 2}
    back = {os.path.relpath(r["file_path"].replace("file:", ""), lake): r["value"] for r in LK.read_message_files(spark, lake).collect()}
    assert back == {
        "telegram_messages/2024-01-01/chana/1.json": '{"id":1,"message":"é"}',
        "telegram_messages/2024-01-02/chanb/2.json": '{"id":2}',
    }


def _mart_rows(spark, root, name):
    df = TB.read_table(spark, root, name)
    cols = sorted(c for c in df.columns if c not in ("loaded_at",))
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_incremental_marts_equal_full_rebuild(spark, scratch):
    lake = os.path.join(scratch, "lake")
    inc, full = os.path.join(scratch, "inc"), os.path.join(scratch, "full")

    def msg(day, mid, ch="chana"):
        _write_msg(lake, day, ch, mid, _msg(mid, 100 if ch == "chana" else 200, day, f"word{mid} shared"))

    def step(as_of):
        for root in (inc, full):
            P.load_messages(spark, lake, root)
        P.build_marts(spark, inc, as_of)
        P.build_marts(spark, full, as_of, full_refresh=True)
        for name in (TB.STG_MESSAGES, TB.DIM_CHANNELS, TB.DIM_DATES, TB.FCT_MESSAGES):
            assert _mart_rows(spark, inc, name) == _mart_rows(spark, full, name), name
        fct = TB.read_table(spark, inc, TB.FCT_MESSAGES)
        words = TB.read_table(spark, inc, TB.RPT_WORD_COUNTS)
        days = TB.read_table(spark, inc, TB.RPT_CHANNEL_DAYS)
        assert [tuple(r) for r in R.top_products_from_rollup(words, 50).collect()] == [
            tuple(r) for r in R.top_products(fct, 50).collect()
        ]
        for ch in (100, 200):
            assert [tuple(r) for r in R.channel_activity_from_rollup(days, ch).collect()] == [
                tuple(r) for r in R.channel_activity(fct, ch).collect()
            ]

    # Spine from 2020-01-01 is capped at 2024-12-30: the 2026 message has no date.
    msg("2020-01-01", 1)
    msg("2024-06-01", 2)
    msg("2026-06-01", 3, "chanb")
    step("2030-01-01")
    fct = TB.read_table(spark, inc, TB.FCT_MESSAGES)
    assert fct.filter("date_day IS NULL").count() == 1
    def part_files(table, day):
        version = SN.snapshot(spark, inc, table)
        folders = [SN.folder(inc, table, i, p) for i, p in version.parts() if p == f"lake_date={day}"]
        return sorted(f for d in folders for f in os.listdir(d))

    untouched = {t: part_files(t, "2020-01-01") for t in (TB.STG_MESSAGES, TB.FCT_MESSAGES)}
    moved = part_files(TB.FCT_MESSAGES, "2024-06-01")
    # An older message moves day 0 and the five-year end: 2024-06-01 leaves the
    # spine although its partition gets no new rows.
    msg("2019-01-01", 4)
    step("2030-01-01")
    assert TB.read_table(spark, inc, TB.FCT_MESSAGES).filter("date_day IS NULL").count() == 2
    assert {t: part_files(t, "2020-01-01") for t in untouched} == untouched
    assert part_files(TB.FCT_MESSAGES, "2024-06-01") != moved
    # No new files, earlier as_of: only the spine moves.
    step("2019-06-01")
    assert TB.read_table(spark, inc, TB.FCT_MESSAGES).filter("date_day IS NOT NULL").count() == 1
    # New rows in an existing partition and a new channel.
    msg("2019-01-01", 5, "chanb")
    step("2019-06-01")
    assert TB.read_table(spark, inc, TB.STG_MESSAGES).count() == 5

    # Nothing new: the build writes no table.
    def listing():
        out = {}
        for base, _dirs, files in os.walk(inc):
            for f in files:
                p = os.path.join(base, f)
                out[p] = os.path.getmtime(p)
        return out

    before = listing()
    P.build_marts(spark, inc, "2019-06-01")
    assert listing() == before


def test_command_line(spark, lake, scratch, capsys):
    from chanmart.__main__ import main

    root = os.path.join(scratch, "wh-cli")
    images = os.path.join(scratch, "images-cli")
    _write_image(images, "2024-01-01", "2.jpg", b"xx")
    assert main(["load", "--lake", lake, "--root", root]) == 0
    assert main(["enrich", "--images", images, "--root", root, "--detector", "test_lake_and_jobs:BoxDetector"]) == 0
    assert main(["build", "--root", root, "--as-of", "2024-01-31"]) == 0
    capsys.readouterr()
    assert main(["test", "--root", root]) == 1  # message id 1 exists in two channels
    assert len(capsys.readouterr().out.strip().splitlines()) == 10
    assert main(["report", "--root", root, "top-products", "2"]) == 0
    out = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert out[0] == {"product_name": "paracetamol", "mention_count": 1} or len(out) == 2
    assert main(["report", "--root", root, "activity", "Channel 100"]) == 0
    days = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert days == [{"post_date": "2024-01-01", "post_count": 2}]
    assert main(["report", "--root", root, "activity", "Channel 999"]) == 2
    assert main(["report", "--root", root, "search", "MASKS"]) == 0
    hits = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert [h["message_text"] for h in hits] == ["masks"]
    assert main(["report", "--root", root, "top-objects"]) == 0


def test_load_by_date_folders(spark, lake, scratch):
    root = os.path.join(scratch, "wh-dates")
    assert P.load_messages(spark, lake, root, dates=["2024-01-02", "2030-01-01"]) == {
        "loaded": 1,
        "already_loaded": 0,
        "rejected": 1,
    }
    assert P.load_messages(spark, lake, root, dates=["2030-01-01"]) == {"loaded": 0, "already_loaded": 0, "rejected": 0}
    assert P.load_messages(spark, lake, root) == {"loaded": 2, "already_loaded": 1, "rejected": 1}
    images = os.path.join(scratch, "images-dates")
    _write_image(images, "2024-01-01", "2.jpg", b"xx")
    _write_image(images, "2024-01-02", "3.jpg", b"x")
    assert P.enrich_images(spark, images, root, BoxDetector, dates=["2024-01-02"]) == {
        "new_detections": 1,
        "failed_images": 0,
    }
    assert P.enrich_images(spark, images, root, BoxDetector) == {"new_detections": 2, "failed_images": 0}


def test_stream_many_micro_batches_keep_ids_unique(spark, lake, scratch):
    root = os.path.join(scratch, "wh-micro")
    ckpt = os.path.join(scratch, "micro-ckpt")
    q = ingest_stream(spark, lake, root, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 4
    raw = TB.read_table(spark, root, TB.RAW_MESSAGES)
    assert raw.count() == 3 and raw.select("id").distinct().count() == 3
    assert TB.read_table(spark, root, TB.RAW_REJECTS).count() == 1


def test_session_conf_is_restored(spark):
    from chanmart.session import session_conf

    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    with session_conf(spark, {key: "12345"}):
        assert spark.conf.get(key) == "12345"
    assert spark.conf.get(key) == before


def test_compact_lake_feeds_the_load_once_job(spark, scratch):
    out = os.path.join(scratch, "compact")
    root = os.path.join(scratch, "wh-compact")
    msgs = spark.createDataFrame(
        [
            (1, "chana", "2024-01-01", json.dumps(_msg(1, 100, "2024-01-01", "one"))),
            (2, "chanb", "2024-01-02", json.dumps(_msg(2, 200, "2024-01-02", "two"))),
            (3, "chanb", "2024-01-02", '{"id": 0}'),
        ],
        "message_id long, channel string, message_date string, payload string",
    )
    LK.write_partitioned_lake(msgs, out)
    landed = LK.read_landed_messages(spark, out)
    assert P.load_message_batch(spark, landed, root) == {"loaded": 2, "already_loaded": 0, "rejected": 1}
    assert P.load_message_batch(spark, landed, root) == {"loaded": 0, "already_loaded": 2, "rejected": 1}
    raw = TB.read_table(spark, root, TB.RAW_MESSAGES)
    assert sorted(r["lake_date"] for r in raw.collect()) == ["2024-01-01", "2024-01-02"]


def test_invalid_utf8_file_is_rejected_as_bad_json(spark, scratch):
    lake = os.path.join(scratch, "lake-bytes")
    d = os.path.join(lake, "telegram_messages", "2024-01-01", "chana")
    os.makedirs(d)
    with open(os.path.join(d, "1.json"), "wb") as f:
        f.write(b'{"id": 1, "message": "\xff\xfe"}')
    with open(os.path.join(d, "2.json"), "wb") as f:
        f.write('{"id": 2, "message": "ünïcödé"}'.encode("utf-8"))
    root = os.path.join(scratch, "wh-bytes")
    assert P.load_messages(spark, lake, root) == {"loaded": 1, "already_loaded": 0, "rejected": 1}
    rejects = TB.read_table(spark, root, TB.RAW_REJECTS).collect()
    assert [(os.path.basename(r["file_path"]), r["reject_reason"]) for r in rejects] == [("1.json", "bad_json")]
