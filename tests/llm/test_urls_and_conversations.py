"""URL filter, conversation repair and conversation trie against brute force, SQL and edge cases."""

import functools
import hashlib
import os
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chanmart.llm import common, url_filter
from chanmart.llm import conversation_repair as R
from chanmart.llm import conversation_trie as T
from chanmart.llm import queries as Q
from tools.compare_oracle import TABLES, _rows

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", ["op11_url_filter", "op12_conversation_repair", "op13_conversation_trie"])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    df = Q.QUERIES[name](spark, SF)
    res = con.execute(Q.ORACLE_SQL[name])
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(cols, res.fetchall())


# --- URL filter ---------------------------------------------------------------


def plain_rule(host, path):
    fits = [(len(h + p), h + p, says) for says, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    ("http://A.example.ORG/es/1?x#y", "a.example.org", "/es/1"),
    ("https://example.org/en/12", "example.org", "/en/12"),
    ("https://example.org/en/2", "example.org", "/en/2"),
    ("https://notexample.org", "notexample.org", ""),
    ("http://x.com/fr/", "x.com", "/fr/"),
    ("http://x.com/de/a/fr/", "x.com", "/de/a/fr/"),
    ("http://xcom/de/", "xcom", "/de/"),
    ("http://listed.net/a/?b=1&a=2&utm_source=q", "listed.net", "/a/"),
    ("HTTPS://www.Listed.net:443/a?a=2&b=1#z", "www.listed.net:443", "/a"),
    ("http://listed.net/b", "listed.net", "/b"),
    ("no scheme", "", ""),
    ("", "", ""),
    (None, "", ""),
    ("a?b#c://É.NET/ü\n/x?q", "É.net", "/ü\n/x"),
    ("http://h", "h", ""),
    ("http://long.net/" + "p" * 100_000, "long.net", "/" + "p" * 100_000),
]


@pytest.mark.parametrize("bits,limit", [(12, 64 << 20), (1, 64 << 20), (12, 0), (1, 0)])
def test_url_filter_matches_brute_force(spark, bits, limit):
    """By broadcast and by parts, with a good filter and with one that passes nearly everything on."""
    rng = random.Random(5)
    pages = [(i, u, "x", "y") for i, (u, _, _) in enumerate(URLS)] * 2 + [(1000 + i, f"http://h{rng.randrange(40)}.net/{rng.randrange(40)}", "x", "y") for i in range(600)]
    hot = [(5000 + i, "http://hot.net/", "x", "y") for i in range(1500)]
    frame = spark.createDataFrame(pages + hot, "page_id long, url string, verdict string, canonical string").repartition(5)
    listed = ["http://listed.net/a?b=1&a=2", "http://listed.net/a/?a=2&b=1", None, "https://hot.net", "http://x.com/de/", "http://long.net/" + "p" * 100_000]
    listed += [f"http://h{i}.net/{i}" for i in range(40)] + [f"http://other{i}.net/" for i in range(3000)]
    got = url_filter.filter_urls(frame, spark.createDataFrame([(u,) for u in listed], "url string"), bits_per_url=bits, broadcast_bytes=limit).collect()
    by_id = {i: (h, p) for i, (_, h, p) in enumerate(URLS)}
    unwanted = {7, 8, 15}
    assert len(got) == len(pages) + len(hot)
    urls = {r[0]: r[1] for r in pages}
    for row in got:
        if row["page_id"] >= 5000:
            assert (row["host"], row["path"], row["rule"], row["verdict"]) == ("hot.net", "/", None, "block")
            continue
        if row["page_id"] < 1000:
            assert (row["host"], row["path"]) == by_id[row["page_id"]]
            is_listed = row["page_id"] in unwanted
        else:
            host, number = urls[row["page_id"]][8:].split(".net/")
            is_listed = host == number
        rule, says = plain_rule(row["host"], row["path"])
        assert row["rule"] == rule and row["verdict"] == (says or ("block" if is_listed else "allow"))


def test_blocked_bloom_has_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(3)
    keys, others = rng.integers(0, 1 << 64, 50_000, np.uint64), rng.integers(0, 1 << 64, 50_000, np.uint64)
    blocks = -(-len(keys) * url_filter.BITS_PER_URL // 512)
    words = url_filter.filled(keys, 0, blocks, blocks)
    assert url_filter.may_hold(words, keys, 0, blocks).all()
    assert url_filter.may_hold(words, others, 0, blocks).mean() < 0.02


def test_url_filter_of_nothing(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    some = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert url_filter.filter_urls(pages, some.select("url")).count() == 0
    assert [r["verdict"] for r in url_filter.filter_urls(some, pages.select("url")).collect()] == ["allow"]


def test_join_spread_meets_hot_and_null_keys(spark):
    rows = [(i, None if i % 7 == 0 else 1 if i % 2 else i) for i in range(6000)]
    left = common.staged(spark.createDataFrame(rows, "i long, k long"), "test-left")
    right = spark.createDataFrame([(k, -k) for k in range(0, 6000, 3)] + [(1, -1)], "k long, v long")
    got = {r["i"]: r["v"] for r in common.join_spread(left, right, "k").collect()}
    assert len(got) == 6000
    assert got == {i: None if k is None or (k % 3 and k != 1) else -k for i, k in rows}


# --- conversation repair ------------------------------------------------------


def plain_repair(rows):
    """(cost, audit, repaired lines) by a search from the end over (row, state); rows are (role, text, fault)."""

    @functools.cache
    def rest(i, state, inserted):
        ways = []
        if i == len(rows) and state in "-a":
            ways.append((0, "", ()))
        if inserted < 3:
            for name in ("user", "assistant"):
                if name[0] in {"-": "u", "s": "u", "u": "a", "a": "u"}[state]:
                    c, a, out = rest(i, name[0], inserted + 1)
                    ways.append((c + 3, "I" + a, (f"{name}:", *out)))
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, out = rest(i + 1, state, 0)
            ways.append((c + 4, "D" + a, out))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                allowed = {"-": "su", "s": "u", "u": "a", "a": "u"}[state]
                if role[:1] and role[:1] in allowed:
                    c, a, out = rest(i + 1, role[0], 0)
                    ways.append((c + more, "K" + a, (f"{role}:{text}", *out)))
                for name in ("user", "assistant"):
                    if name[0] in allowed:
                        c, a, out = rest(i + 1, name[0], 0)
                        ways.append((c + more + 3, "R" + a, (f"{name}:{text}", *out)))
        return min(ways, default=(10**9, "", ()))

    return rest(0, "-", 0)


def plain_summary(turns):
    """turns: (turn, role, text), the rows present."""
    rows, seen, counts = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for turn, role, text in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode())):
        bare = text.strip(R.BLANKS)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        rows.append((role, text, fault))
    numbers = {t[0] for t in turns if t[0] is not None}
    cost, audit, lines = plain_repair(tuple(rows))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    return {**counts, "illegal": illegal, "gaps": gaps, "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def random_conversations(seed, n, longest):
    rng = random.Random(seed)
    out = {}
    for c in range(n):
        out[c if c else None] = [
            (rng.choice([None, *range(8)]), rng.choice(["user", "assistant", "system", "user", "assistant", "unknown", "", "tool"]), rng.choice(["", " \n", "a.", "b!", "c", "d ", "é?\t", f"{rng.random()}."]))
            for _ in range(rng.randrange(longest))
        ]
    return out


def test_repair_matches_brute_force(spark):
    convs = random_conversations(11, 500, 14)
    rows = [(c, t, r, x, True) for c, turns in convs.items() for t, r, x in turns] + [(c, None, "x", "y", False) for c in convs]
    frame = spark.createDataFrame(rows, TURNS + ", present boolean").withColumn("fault", F.lit("clash")).repartition(4)
    got = {r["conv_id"]: r.asDict() for r in R.repair_summaries(frame).collect()}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        want = plain_summary(turns)
        assert {k: got[c][k] for k in want} == want, (c, turns)


def test_repair_edits_give_the_repaired_turns(spark):
    frame = spark.createDataFrame([(1, 0, "system", "s.", True), (1, 1, "assistant", "a.", True), (1, 2, "assistant", "", None)], TURNS + ", present boolean")
    got = [tuple(r)[1:] for r in R.repair_edits(frame).orderBy("step").collect()]
    assert got == [(0, "K", "system", "s."), (1, "I", "user", ""), (2, "K", "assistant", "a."), (3, "D", None, None)]


def test_damage_follows_the_code_of_the_row(spark):
    rows = [(c, t, "system", "a. b! c") for c in [None, *range(40)] for t in (None, 0, 1)] + [(7, 5, None, None)]
    got = R.damaged(spark.createDataFrame(rows, TURNS)).collect()
    want = []
    for c, t, role, text in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = {1: "", 2: "".join(x for x in text if x not in ".!?")}.get(code, text)
        want += [(c, t, "user" if code == 4 else role, text, code != 0)] * (2 if code == 3 else 1)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_repair_remembers_only_its_unresolved_end():
    """100,000 legal turns, then a hundred blank ones: the tree never holds more than these."""
    search, given, deepest = R.Repair(), 0, 0
    for i in range(100_000):
        given += len(list(search.push("user" if i % 2 == 0 else "assistant", "x.", 0)))
        deepest = max(deepest, i + 1 - given)
    assert deepest < 20
    for _ in range(100):
        given += len(list(search.push("user", "", 1)))
    cost, rest = search.finish()
    assert cost == 400 and len(rest) < 130 and given + len(rest) == 100_100


def test_repair_of_nothing_and_of_long_texts(spark):
    schema = TURNS + ", present boolean"
    assert R.repair_summaries(spark.createDataFrame([], schema)).count() == 0
    long = "wörd " * 200_000 + "."
    (row,) = R.repair_summaries(spark.createDataFrame([(1, 0, "user", long, True), (1, 1, "assistant", long, True)], schema)).collect()
    assert row["audit"] == "KK" and row["repaired_sha256"] == hashlib.sha256(f"user:{long}\nassistant:{long}".encode()).hexdigest()


# --- conversation trie --------------------------------------------------------


def plain_trie(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [(r, x) for _, _, r, x in sorted(v, key=lambda t: t[:2])] for c, v in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = turns.get(c - c % 100, [])[:h] + turns[c][h:]
    nodes = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for seq in nodes:
        if seq:
            children[seq[:-1]] = children.get(seq[:-1], 0) + 1
    for seq, members in nodes.items():
        for d in range(len(seq) + 1):
            top = seq[:d]
            leaves[top] = leaves.get(top, 0) + (seq not in children)
            saved[top] = saved.get(top, 0) + (len(members) - 1) * (len(seq[-1][1]) if seq else 0)
    out = []
    for seq, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(seq))
        parent = min(nodes[seq[:-1]]) if seq else None
        out.append((min(members), len(seq), parent, len(members), children.get(seq, 0), leaves[seq], saved[seq], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(spark, rows, block_turns, extra=None):
    frame = spark.createDataFrame(rows, TURNS).repartition(4)
    for name in (extra or "").split():
        frame = frame.withColumn(name, F.lit("clash"))
    turns = common.staged(T.narrow_turns(frame), "test-turns")
    return sorted((tuple(r) for r in T.prefix_trie(T.shared_heads(turns), block_turns).select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("block_turns", [1, 3, 4])
def test_trie_matches_brute_force(spark, block_turns):
    rng = random.Random(7)
    rows = []
    for c in [*range(0, 60), *range(100, 130), *range(205, 230), 1000]:
        n = rng.choice([1, 2, 3, 4, 5, 6, 8, 9, 12])
        start = rng.randrange(3)  # many conversations go the same way for a while
        for t in range(n):
            same = rng.random() < 0.85
            rows.append((c, t if rng.random() < 0.95 else -t, rng.choice(["user", None]) if not same else "user", f"text {start} {t}" if same else rng.choice(["ü" * rng.randrange(9), None, f"{rng.random()}"])))
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())
    rows += [(400, None, "user", "first"), (400, 1, "user", None), (None, 1, "user", "nobody")]
    rows += [(c, t, "user", f"copy {t}") for c in range(500, 560) for t in range(7)]
    assert trie(spark, rows, block_turns, "digest place own") == plain_trie(rows)


def test_trie_of_nothing_of_the_root_alone_and_of_long_texts(spark):
    assert trie(spark, [], 4) == []
    short = next(c for c in range(100, 200) if c % 100 and zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(short, 0, "user", "its only turn, which a head replaces that nobody lends")]
    assert trie(spark, rows, 4) == plain_trie(rows)
    rows = [(c, 0, "user", "wörd " * 100_000) for c in (100, 101, 102)] + [(100, 1, "a", "b")]
    assert trie(spark, rows, 4) == plain_trie(rows)


def test_trie_keeps_repeated_turns(spark):
    rows = [(100, 1, "user", "same"), (100, 1, "user", "same"), (300, 1, "user", "same")]
    assert trie(spark, rows, 2) == plain_trie(rows)
