"""Top words from merged partials equal the full count and read less."""

import random
from collections import Counter

import pytest

from chanmart.plans import top_words as TW
from chanmart.sources import snapshots as SN
from chanmart.sources import tables as TB

SCHEMA = "product_name string, mention_count long, lake_date string"


def put(spark, root, counts, mode="overwrite"):
    rows = [(w, n, day) for day, c in counts.items() for w, n in c.items()]
    TB.write_table(spark.createDataFrame(rows, SCHEMA).orderBy("lake_date"), root, TB.RPT_WORD_COUNTS, mode, ["lake_date"])


def full(counts, k):
    total = sum(counts.values(), Counter())
    return sorted(total.items(), key=lambda x: (-x[1], x[0]))[:k]


def asked(spark, root, k, seen=None):
    return [tuple(r) for r in TW.top_products_bounded(spark, root, k, seen).collect()]


@pytest.mark.parametrize("shape", ["zipf", "flat", "disjoint", "tied"])
def test_equals_the_full_count_on_random_data(spark, scratch, shape):
    rng = random.Random(shape)
    counts = {}
    for day in [f"2024-{m:02d}-{d:02d}" for m in (1, 2, 3) for d in range(1, 9)] + ["undated"]:
        if shape == "zipf":
            counts[day] = Counter({f"w{i}": max(1, int(rng.uniform(0.5, 2) * 5000 / (i + 1))) for i in range(400)})
        elif shape == "flat":
            counts[day] = Counter({f"w{i}": rng.randrange(1, 20) for i in range(200)})
        elif shape == "disjoint":
            counts[day] = Counter({f"{day}{i}": rng.randrange(1, 3000) for i in range(50)})
        else:
            counts[day] = Counter({f"w{i}": 7 for i in rng.sample(range(60), 30)})
    put(spark, scratch, counts)
    before = asked(spark, scratch, 10)  # nothing merged yet
    TW.build_period_counts(spark, scratch)
    rows, partials = TW.partial_counts(spark, scratch)
    assert partials == 2 + 8 + 1 < len(counts)  # two months over, the running one's days, the undated
    for k in (1, 10, 75):
        seen = []
        assert asked(spark, scratch, k, seen) == full(counts, k)
        if shape == "zipf" and k == 10:
            words = rows.select("product_name").distinct().count()
            assert seen[-1][1] < words / 4  # heads only
    assert before == full(counts, 10)


def test_merged_periods_follow_their_dates(spark, scratch):
    counts = {f"2024-{m:02d}-{d:02d}": Counter({f"w{i}": 10 * m + d + i for i in range(30)}) for m in (1, 2, 3) for d in (1, 2, 3)}
    put(spark, scratch, counts)
    TW.build_period_counts(spark, scratch)
    first = {p: i for i, p in SN.snapshot(spark, scratch, TB.RPT_PERIOD_WORDS).parts()}
    assert set(first) == {"period=2024-01", "period=2024-02"}
    # A late file changes a day of a merged month: until that is merged anew, its days are asked one by one.
    late = {"2024-01-02": Counter({"late": 10_000, "w1": 3}), "2024-03-04": Counter({"w2": 5})}
    put(spark, scratch, late, "partitions")
    counts |= late
    assert TW.partial_counts(spark, scratch)[1] == 1 + 3 + 4
    assert asked(spark, scratch, 5) == full(counts, 5)
    TW.build_period_counts(spark, scratch)
    now = {p: i for i, p in SN.snapshot(spark, scratch, TB.RPT_PERIOD_WORDS).parts()}
    assert now["period=2024-02"] == first["period=2024-02"] and now["period=2024-01"] != first["period=2024-01"]
    assert TW.partial_counts(spark, scratch)[1] == 2 + 4 and asked(spark, scratch, 5) == full(counts, 5)
    written = TB.written(spark, scratch, TB.RPT_PERIOD_WORDS)
    TW.build_period_counts(spark, scratch)
    assert TB.written(spark, scratch, TB.RPT_PERIOD_WORDS) == written
    # March is over when April begins.
    put(spark, scratch, {"2024-04-01": Counter({"w3": 1})}, "partitions")
    counts["2024-04-01"] = Counter({"w3": 1})
    TW.build_period_counts(spark, scratch)
    assert TW.partial_counts(spark, scratch)[1] == 4 and asked(spark, scratch, 40) == full(counts, 40)


def test_nothing_counted(spark, scratch):
    put(spark, scratch, {"2024-01-01": Counter()})
    TW.build_period_counts(spark, scratch)
    assert asked(spark, scratch, 10) == []
