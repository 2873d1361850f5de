"""The skipping index gives the rows of a full scan and reads fewer files."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chanmart.operators import reports as R
from chanmart.plans import search_index as SI
from chanmart.sources import snapshots as SN
from chanmart.sources import tables as TB

COLUMNS = "message_id long, channel_id long, message_posted_at timestamp_ntz, message_text string, lake_date string"
WORDS = ["aspirin", "Vitamin", "ÉCHINACEA", "syrup", "50%", "a_b", "c\\d", "İlaç", "ΣΟΦΟΣ", "ß", "x"]


def facts(spark, rng, days, per_day=20):
    rows = []
    for day in days:
        own = rng.sample(WORDS, 3)  # some words are in some days' files only
        for i in range(per_day):
            rows.append((len(rows), 1, None, rng.choice([None, "", " ".join(rng.choices(own, k=rng.randrange(5)))]), f"2024-01-{day:02d}"))
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("index"))
    TB.write_table(facts(spark, random.Random(3), range(1, 13)), root, TB.FCT_MESSAGES, partition_by=["lake_date"])
    SI.build_search_index(spark, root)
    return root


def same(spark, root, query):
    full = R.search_messages(TB.read_table(spark, root, TB.FCT_MESSAGES), query, 1000).collect()
    got = SI.search_messages_indexed(spark, root, query, 1000).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in full], query
    return len(full)


PATTERNS = st.lists(st.sampled_from(["asp", "irin", "vit", "amin", "é", "chin", "%", "_", "\\%", "\\_", "\\\\", "\\c", "ilaç", "i̇laç", "σοφος", "σοφοσ", "SS", "ß", " ", "x"]), max_size=5).map("".join)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(query=PATTERNS)
def test_any_pattern_finds_what_a_full_scan_finds(spark, warehouse, query):
    if query.endswith("\\") and not query.endswith("\\\\"):
        query += "\\"
    same(spark, warehouse, query)


def test_files_without_the_words_are_skipped(spark, warehouse):
    for word in ("aspirin", "ECHINACEA", "v_tamin", "syr%x", "50\\%"):
        found = same(spark, warehouse, word)
        files, known, rest = SI.candidate_files(spark, warehouse, word)
        holding = TB.read_table(spark, warehouse, TB.FCT_MESSAGES).filter(F.col("message_text").ilike(f"%{word}%")).select("lake_date").distinct().count()
        assert rest == [] and known == 12 and holding <= len(files) < known, (word, found)
    assert SI.candidate_files(spark, warehouse, "nowhere")[0] == []
    assert SI.candidate_files(spark, warehouse, "x")[0] is None and SI.candidate_files(spark, warehouse, "a%b_c")[0] is None


def test_the_index_follows_rebuilt_dates_and_uncovered_files_are_scanned(spark, scratch):
    rng = random.Random(5)
    TB.write_table(facts(spark, rng, range(1, 6)), scratch, TB.FCT_MESSAGES, partition_by=["lake_date"])
    assert same(spark, scratch, "aspirin") >= 0  # no index at all
    SI.build_search_index(spark, scratch)
    first = {p: i for i, p in SN.snapshot(spark, scratch, TB.SEARCH_INDEX).parts()}
    TB.write_table(spark.createDataFrame([(900, 1, None, "brandnew words", "2024-01-03")], COLUMNS), scratch, TB.FCT_MESSAGES, "partitions", ["lake_date"])
    assert same(spark, scratch, "brandnew") == 1  # its folder has no signature yet
    assert SI.candidate_files(spark, scratch, "brandnew")[2] != []
    SI.build_search_index(spark, scratch)
    now = {p: i for i, p in SN.snapshot(spark, scratch, TB.SEARCH_INDEX).parts()}
    assert {p for p in now if now[p] != first[p]} == {"lake_date=2024-01-03"}
    files, known, rest = SI.candidate_files(spark, scratch, "brandnew")
    assert (len(files), known, rest) == (1, 5, []) and same(spark, scratch, "brandnew") == 1
    written = TB.written(spark, scratch, TB.SEARCH_INDEX)
    SI.build_search_index(spark, scratch)
    assert TB.written(spark, scratch, TB.SEARCH_INDEX) == written


def test_trigrams_span_pieces_of_a_long_text(spark, scratch, monkeypatch):
    long = "q" * (SI.CHUNK - 1) + "needle" + "r" * 100
    TB.write_table(spark.createDataFrame([(1, 1, None, long, "2024-01-01"), (2, 1, None, "other", "2024-01-02")], COLUMNS), scratch, TB.FCT_MESSAGES, partition_by=["lake_date"])
    SI.build_search_index(spark, scratch)
    assert len(SI.candidate_files(spark, scratch, "qneedler")[0]) == 1 and same(spark, scratch, "qneedler") == 1
