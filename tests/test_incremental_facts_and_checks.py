"""Detection facts and check results that follow changes equal those of a full rebuild."""

import os

import pytest

from chanmart.operators import checks as C
from chanmart.plans import check_state as CI
from chanmart.plans import jobs as P
from chanmart.plans import marts as M
from chanmart.sources import snapshots as SN
from chanmart.sources import tables as TB
from test_lake_and_jobs import _msg, _write_msg


def rows(spark, root, name):
    df = TB.read_table(spark, root, name)
    return sorted((tuple(r) for r in df.select(*sorted(c for c in df.columns if c not in ("loaded_at", "bucket"))).collect()), key=repr)


def results(df):
    return sorted(map(tuple, df.collect()))


class Warehouse:
    """Two warehouses that get the same input: one built by changes, one whole each time."""

    def __init__(self, spark, scratch):
        self.spark, self.lake = spark, os.path.join(scratch, "lake")
        self.roots = [os.path.join(scratch, x) for x in ("inc", "full")]
        self.boxes = 0

    def land(self, day, number, channel="chana"):
        _write_msg(self.lake, day, channel, number, _msg(number, 100 if channel == "chana" else 200, day, f"word{number}"))

    def detect(self, *messages):
        batch = [(self.boxes + i, m, f"images/2024-01-01/{m}.jpg", f"class_{m % 3}", 0.5, [float(i)], None, "2024-01-01") for i, m in enumerate(messages)]
        self.boxes += len(batch)
        for root in self.roots:
            frame = self.spark.createDataFrame(batch, P.SC.RAW_IMAGE_DETECTIONS)
            TB.write_table(frame, root, TB.RAW_IMAGE_DETECTIONS, "append", ["image_date"])

    def step(self, as_of):
        inc, full = self.roots
        for root in self.roots:
            P.load_messages(self.spark, self.lake, root)
        P.build_marts(self.spark, inc, as_of, buckets=8)
        P.build_marts(self.spark, full, as_of, full_refresh=True, buckets=8)
        for name in (TB.STG_MESSAGES, TB.DIM_CHANNELS, TB.DIM_DATES, TB.FCT_MESSAGES, TB.MESSAGE_KEYS, TB.STG_DETECTIONS, TB.FCT_IMAGE_DETECTIONS):
            assert rows(self.spark, inc, name) == rows(self.spark, full, name), name
        plain = M.fct_image_detections(TB.read_table(self.spark, full, TB.STG_DETECTIONS), TB.read_table(self.spark, full, TB.FCT_MESSAGES))
        got = TB.read_table(self.spark, inc, TB.FCT_IMAGE_DETECTIONS).select(*plain.columns)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
        whole = results(P.run_mart_checks(self.spark, full))
        assert results(CI.run_checks_incremental(self.spark, inc)) == whole
        assert results(CI.run_checks_incremental(self.spark, inc)) == whole  # nothing new
        return {tuple(r[:3]): r[3] for r in whole}

    def buckets(self):
        """Which write each bucket of the detection facts is from."""
        return {p: i for i, p in SN.snapshot(self.spark, self.roots[0], TB.FCT_IMAGE_DETECTIONS).parts()}


@pytest.fixture()
def warehouse(spark, scratch):
    return Warehouse(spark, scratch)


UNIQUE, LOST = ("fct_messages", "message_id", "unique"), ("fct_image_detections", "message_id", "relationships")


def test_changes_give_what_a_rebuild_gives(warehouse):
    w = warehouse
    for n in range(1, 7):
        w.land("2024-01-01", n)
    w.detect(1, 1, 2, 50, 51)  # two of messages that aren't there yet
    failures = w.step("2024-01-10")
    assert failures[LOST] == 2 and failures[UNIQUE] == 0
    # A message arrives for a waiting box, and one with an id that another channel has.
    first = w.buckets()
    w.land("2024-01-02", 50)
    w.land("2024-01-02", 2, "chanb")
    failures = w.step("2024-01-10")
    assert failures[LOST] == 1 and failures[UNIQUE] == 1
    now = w.buckets()
    assert set(now) == set(first) and any(now[b] == first[b] for b in now) and any(now[b] != first[b] for b in now)
    # Boxes alone; then nothing at all.
    w.detect(3, 2)
    w.step("2024-01-10")
    before = {t: TB.written(w.spark, w.roots[0], t) for t in P.MODEL_TABLES}
    w.step("2024-01-10")
    assert {t: TB.written(w.spark, w.roots[0], t) for t in P.MODEL_TABLES} == before
    # The spine's end moves in front of the messages of day 2, and back.
    w.step("2024-01-01")
    w.step("2024-01-10")
    # An older message moves day 0 and the five-year end.
    w.land("2018-06-01", 90)
    w.detect(90)
    w.step("2030-01-01")
    w.land("2018-05-31", 51)
    assert w.step("2030-01-01")[LOST] == 0


def test_nothing_of_the_history_is_shuffled_for_detection_facts(spark, warehouse, monkeypatch):
    w = warehouse
    for n in range(1, 30):
        w.land("2024-01-01", n)
    w.detect(*range(1, 20))
    w.step("2024-01-10")
    w.land("2024-01-02", 40)
    w.detect(40, 3)
    plans, own = [], SN.write_snapshot

    def noting(df, root, name, *args, **kwargs):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return own(df, root, name, *args, **kwargs)

    monkeypatch.setattr(SN, "write_snapshot", noting)
    P.load_messages(spark, w.lake, w.roots[0])
    P.build_marts(spark, w.roots[0], "2024-01-10")
    facts = [plan for name, plan in plans if name == TB.FCT_IMAGE_DETECTIONS]
    assert len(facts) == 1 and "Exchange" not in facts[0] and facts[0].count("Bucketed: true") == 2


def test_a_hot_message_is_no_task_of_its_own(spark, warehouse, monkeypatch):
    """A third of all boxes on one message: its rows are split and met by broadcast; the facts are the same."""
    w = warehouse
    monkeypatch.setattr(P, "LARGE_BUCKET", 1)
    for n in range(1, 30):
        w.land("2024-01-01", n)
    w.land("2024-01-02", 5, "chanb")  # the hot id stands for two messages
    w.detect(*range(1, 40), *[5] * 3000)
    asked, own = [], P._hot_messages
    monkeypatch.setattr(P, "_hot_messages", lambda *a: asked.append(own(*a)) or asked[-1])
    w.step("2024-01-10")
    assert asked == [[5], [5]]
    monkeypatch.setattr(P, "HOT_KEYS", 1)
    w.detect(*[5] * 100)
    w.step("2024-01-10")
    assert asked[-2:] == [[], []]


def test_bucketed_tables_are_merged_and_stay_right(warehouse, monkeypatch):
    w = warehouse
    monkeypatch.setattr(P, "MERGE_WRITES", 3)
    monkeypatch.setattr(CI, "MERGE_WRITES", 3)
    for n in range(1, 7):
        w.land(f"2024-01-0{n}", n)
        w.detect(n, n + 1)
        w.step("2024-01-10")
    live = {t: len(SN.snapshot(w.spark, w.roots[0], t).live) for t in (TB.MESSAGE_KEYS, TB.STG_DETECTIONS, TB.CHECK_KEYS)}
    assert all(n < 3 for n in live.values()), live


def test_checks_follow_repeats_rebuilds_and_nulls(spark, scratch):
    """Tables written by hand, so that every kind of failure comes and goes."""
    def put(facts, channels, boxes, mode="overwrite"):
        TB.write_table(spark.createDataFrame(facts, "message_id long, channel_id long, lake_date string"), scratch, TB.FCT_MESSAGES, mode, ["lake_date"])
        TB.write_table(spark.createDataFrame(channels, "channel_id long, channel_name string"), scratch, TB.DIM_CHANNELS)
        TB.write_table(spark.createDataFrame(boxes, "detection_id long, message_id long"), scratch, TB.FCT_IMAGE_DETECTIONS)

    def check():
        whole = results(P.run_mart_checks(spark, scratch))
        assert results(CI.run_checks_incremental(spark, scratch)) == whole
        return [r[3] for r in whole if r[3]]

    put([(1, 10, "a"), (2, 11, "a"), (3, 10, "b")], [(10, "x"), (11, "y")], [(1, 1), (2, 3)])
    assert check() == []
    put([(1, 10, "b"), (1, None, "b"), (None, 12, "b")], [(10, "x"), (10, "z"), (None, "n")], [(1, 1), (1, 9), (None, 9), (4, None)], "partitions")
    assert len(check()) >= 8
    put([(3, 11, "b")], [(10, "x"), (11, "y")], [(1, 1), (2, 3)], "partitions")
    assert check() == []
    put([(3, 11, "c"), (3, 11, "c")], [(10, "x"), (11, "y")], [(1, 1), (2, 3)], "append")
    assert check() == [1]
    # Old versions that the state still names are gone: it is counted anew.
    put([(7, 10, "a")], [(10, "x")], [(1, 8)])
    for name in CI.CHECKED:
        SN.collect_garbage(spark, scratch, name, grace_seconds=-60)
    assert check() == [1]


def test_an_incremental_check_reads_what_changed_and_the_state(spark, warehouse, monkeypatch):
    w = warehouse
    for n in range(1, 20):
        w.land(f"2024-01-{n:02d}", n)
    w.detect(1, 2)
    w.step("2024-01-31")
    w.land("2024-01-20", 99)
    inc = w.roots[0]
    P.load_messages(spark, w.lake, inc)
    P.build_marts(spark, inc, "2024-01-31")
    read, own = [], SN.read_parts
    monkeypatch.setattr(SN, "read_parts", lambda s, r, name, v, parts: read.append((name, sorted(p for _, p in parts))) or own(s, r, name, v, parts))
    CI.run_checks_incremental(spark, inc)
    assert read == [(TB.FCT_MESSAGES, ["lake_date=2024-01-20"])]


def test_pinned_versions_outlive_the_collection(warehouse):
    w = warehouse
    w.land("2024-01-01", 1)
    w.step("2024-01-31")
    inc = w.roots[0]
    for n in (2, 3):
        w.land("2024-01-01", n)
        P.load_messages(w.spark, w.lake, inc)
        P.build_marts(w.spark, inc, "2024-01-31", grace_seconds=-60)
    assert results(CI.run_checks_incremental(w.spark, inc)) == results(C.run_checks(*(TB.read_table(w.spark, inc, t) for t in CI.CHECKED)))
