"""Most mentioned words from merged partial counts, reading their heads first.

``rpt_word_counts`` has a partial count for every lake date.  Periods that are
over (by default months: dates with the same first ``PERIOD`` characters,
followed by a later one) are merged to one partial each, kept beside it and made
anew when one of their dates is; dates of the running period, and of periods not
merged yet, are taken one by one.

All partials lie by descending count.  A query reads of each only the rows with
at least t mentions, which is a pushed filter that skips whole row groups.  A
word seen in some of the P partials has at least the sum s of what was seen and
at most  s + (t - 1) * (partials where it wasn't seen);  one not seen at all has
at most (t - 1) * P.  Once the k-th largest s is above what any word outside
the candidates can reach, these are few; their exact counts are then looked up.
Else t is halved, down to 1, which is the full count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanmart.operators import reports as R
from chanmart.sources import snapshots as SN
from chanmart.sources import tables as TB

#: Characters of a date that name its period: 7 for months.
PERIOD = 7
#: Candidates looked up by name; beyond them t is halved once more.
MAX_CANDIDATES = 1000
#: Each step's t is the one before divided by this.
STEP = 4


def _date(part: str) -> str:
    return part.split("=", 1)[1]


def _periods(version: SN.Snapshot, period: int) -> dict[str, list[list[str]]]:
    """[folder id, partition] of the dates of each period that is over."""
    dated: dict[str, list[list[str]]] = {}
    for i, p in sorted(version.parts()):
        if _date(p)[:4].isdigit():
            dated.setdefault(_date(p)[:period], []).append([i, p])
    running = max(dated, default=None)
    return {k: v for k, v in dated.items() if k != running}


def build_period_counts(spark: SparkSession, root: str, full: bool = False, period: int = PERIOD) -> None:
    """Merge the word counts of periods that are over, where they aren't yet or one of their dates has changed."""
    now = SN.snapshot(spark, root, TB.RPT_WORD_COUNTS)
    meta = {} if full else TB.meta(spark, root, TB.RPT_PERIOD_WORDS)
    covered = meta.get("covered", {}) if meta.get("period") == period else {}
    wanted = _periods(now, period)
    changed = sorted(k for k, v in wanted.items() if covered.get(k) != v)
    gone = sorted(set(covered) - set(wanted))
    exists = TB.table_exists(spark, root, TB.RPT_PERIOD_WORDS)
    if exists and not changed and not gone and covered == wanted:
        return
    parts = [tuple(x) for k in changed for x in wanted[k]]
    counts = SN.read_parts(spark, root, TB.RPT_WORD_COUNTS, now, parts)
    merged = counts.groupBy(F.substring("lake_date", 1, period).alias("period"), "product_name").agg(F.sum("mention_count").alias("mention_count"))
    mode = "partitions" if exists and covered else "overwrite"
    replaced = [f"period={k}" for k in (*changed, *gone)]
    meta = {"covered": wanted, "period": period}
    TB.write_table(merged, root, TB.RPT_PERIOD_WORDS, mode, ["period"], meta, [F.col("mention_count").desc()], replaced)


def partial_counts(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    """(product_name, mention_count) rows of the fewest partials that cover all dates, and the number of partials."""
    now = SN.snapshot(spark, root, TB.RPT_WORD_COUNTS)
    merged = SN.snapshot(spark, root, TB.RPT_PERIOD_WORDS)
    covered = merged.meta["covered"] if merged else {}
    live = {tuple(x) for x in now.parts()}
    whole = {k for k, v in covered.items() if {tuple(x) for x in v} <= live and {x for x in live if _date(x[1]).startswith(k)} == {tuple(x) for x in v}}
    rest = sorted(x for x in live if not any(_date(x[1]).startswith(k) for k in whole))
    columns = ["product_name", "mention_count"]
    rows = SN.read_parts(spark, root, TB.RPT_WORD_COUNTS, now, rest).select(*columns)
    if whole:
        rows = rows.unionByName(TB.read_table(spark, root, TB.RPT_PERIOD_WORDS, dates=sorted(whole)).select(*columns))
    return rows, len(rest) + len(whole)


def _ordered(counts: DataFrame, limit: int) -> DataFrame:
    return counts.orderBy(F.col("mention_count").desc_nulls_first(), F.col("product_name").asc_nulls_last()).limit(limit)


def top_products_bounded(spark: SparkSession, root: str, limit: int = R.TOP_LIMIT, seen: list | None = None) -> DataFrame:
    """``top_products`` from the kept partial counts: the same rows.

    ``seen`` gets (t, words read, candidates) of each step.
    """
    rows, partials = partial_counts(spark, root)
    largest = rows.agg(F.max("mention_count")).first()[0]
    if largest is None or limit <= 0:
        return _ordered(rows.groupBy("product_name").agg(F.sum("mention_count").alias("mention_count")), limit)
    t = int(largest)
    while (t := t // STEP) > 1:
        head = rows.filter(F.col("mention_count") >= t).groupBy("product_name").agg(F.sum("mention_count").alias("s"), F.count(F.lit(1)).alias("n"))
        head = head.withColumn("most", F.col("s") + (F.lit(partials) - F.col("n")) * (t - 1))
        # Two short lists: the k largest sums, and of the largest bounds one more than are looked up.
        sums = [r["s"] for r in head.orderBy(F.desc("s")).limit(limit).collect()]
        if len(sums) < limit or sums[-1] <= (t - 1) * partials:
            if seen is not None:
                seen.append((t, None, None))
            continue
        names = [r["product_name"] for r in head.filter(F.col("most") >= sums[-1]).select("product_name").limit(MAX_CANDIDATES + 1).collect()]
        if seen is not None:
            seen.append((t, head.count(), len(names)))
        if len(names) <= MAX_CANDIDATES:
            exact = rows.filter(F.col("product_name").isin(names))
            return _ordered(exact.groupBy("product_name").agg(F.sum("mention_count").alias("mention_count")), limit)
    return _ordered(rows.groupBy("product_name").agg(F.sum("mention_count").alias("mention_count")), limit)
