"""The ten mart tests kept up to date: only what changed since the last run is counted.

The state is a table of key counts, (space, key, n_parent, n_child), one space
for each key that the tests are about:

=============  ==================================  ======================================
space          parent (unique, not_null)           child (not_null, relationship)
=============  ==================================  ======================================
``message``    fct_messages.message_id             fct_image_detections.message_id
``channel``    dim_channels.channel_id             fct_messages.channel_id
``detection``  fct_image_detections.detection_id   none
=============  ==================================  ======================================

Counts can be added up, so the table holds changes: a key's count is the sum of
its rows.  A run compares the tables' present versions with those that the last
run saw.  Data folders that came count for, those that went (their files are
kept until a run has seen that) count against; the keys whose counts really
changed are few beside the history.  Only they are looked up in the state,
which lies by hash of the key and is not shuffled for it, and the failures of
each test move by the difference: a key that is held twice now, or no more; a
child row that lost its parent, or found it.  The changes, the new failure
counts and the versions seen are stored by one commit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanmart.operators import checks as C
from chanmart.session import staging_path
from chanmart.sources import snapshots as SN
from chanmart.sources import tables as TB

#: (space, table, column, whether its keys are the parents)
KEYS = (
    ("message", TB.FCT_MESSAGES, "message_id", True),
    ("message", TB.FCT_IMAGE_DETECTIONS, "message_id", False),
    ("channel", TB.DIM_CHANNELS, "channel_id", True),
    ("channel", TB.FCT_MESSAGES, "channel_id", False),
    ("detection", TB.FCT_IMAGE_DETECTIONS, "detection_id", True),
)
CHECKED = (TB.FCT_MESSAGES, TB.DIM_CHANNELS, TB.FCT_IMAGE_DETECTIONS)
STATE = "space string, key long, n_parent long, n_child long"
#: Live writes of the state before they are merged into one.
MERGE_WRITES = 64


def pinned(spark: SparkSession, root: str, name: str) -> set[str]:
    """Data folders of a table that the next run of the tests still has to count against."""
    seen = TB.meta(spark, root, TB.CHECK_KEYS).get("seen", {}).get(name)
    return {i for i, _ in seen["parts"]} if seen else set()


def _seen(version: SN.Snapshot) -> dict:
    # The schema is needed to read folders that the present version no longer names.
    return {"parts": sorted([i, p] for i, p in version.parts()), "schema": version.schema, "by": version.partition_by}


def _changes(spark: SparkSession, root: str, name: str, seen: dict | None) -> list[tuple[int, DataFrame]]:
    """(+1, rows that came) and (-1, rows that went) since the version ``seen``, each if there are any."""
    now = SN.snapshot(spark, root, name)
    old = {(i, p) for i, p in seen["parts"]} if seen else set()
    came, went = now.parts() - old, old - now.parts()
    out = []
    if came:
        out.append((1, SN.read_parts(spark, root, name, now, came)))
    if went:
        before = SN.Snapshot(schema=seen["schema"], partition_by=seen["by"])
        out.append((-1, SN.read_parts(spark, root, name, before, went)))
    return out


def _at_hand(spark: SparkSession, root: str, name: str, seen: dict | None) -> bool:
    """Whether all folders that the last run saw are still there."""
    have = {f.removeprefix(f"{SN.ID}=") for f, _ in SN.folders(spark, TB.table_path(root, name))}
    return seen is None or {i for i, _ in seen["parts"]} <= have


def key_changes(spark: SparkSession, root: str, seen: dict) -> DataFrame | None:
    """``STATE`` rows of the keys whose counts changed since ``seen`` (NULL keys are counted like others); None if no table changed."""
    rows = []
    for name in CHECKED:
        for sign, frame in _changes(spark, root, name, seen.get(name)):
            pairs = [(space, column, parent) for space, table, column, parent in KEYS if table == name]
            # One scan a table: each row gives one key for each of its columns.
            keys = ", ".join(f"'{s}', CAST({c} AS BIGINT), {sign if p else 0}L, {0 if p else sign}L" for s, c, p in pairs)
            rows.append(frame.selectExpr(f"stack({len(pairs)}, {keys}) AS (space, key, n_parent, n_child)"))
    if not rows:
        return None
    sums = reduce(DataFrame.unionByName, rows).groupBy("space", "key").agg(F.sum("n_parent").alias("n_parent"), F.sum("n_child").alias("n_child"))
    return sums.filter("n_parent <> 0 OR n_child <> 0")


def failure_changes(changes: DataFrame, state: DataFrame | None) -> DataFrame:
    """(space, nulls_parent, nulls_child, duplicates, orphans): by how much each failure count moves."""
    new = changes.select("space", "key", F.lit(0).cast("long").alias("old_p"), F.lit(0).cast("long").alias("old_c"), "n_parent", "n_child")
    if state is not None:
        # The changed keys meet the state where it lies; what comes out is as many rows as they have.
        keys = changes.filter("key IS NOT NULL").select("space", "key")
        none = F.lit(0).cast("long")
        known = state.join(keys, ["space", "key"]).select(
            "space", "key", F.col("n_parent").alias("old_p"), F.col("n_child").alias("old_c"), none.alias("n_parent"), none.alias("n_child")
        )
        new = new.unionByName(known)
    per_key = new.groupBy("space", "key").agg(*(F.sum(c).alias(c) for c in ("old_p", "old_c", "n_parent", "n_child")))
    was_p, was_c = F.col("old_p"), F.col("old_c")
    now_p, now_c = was_p + F.col("n_parent"), was_c + F.col("n_child")
    null = F.col("key").isNull()

    def one(c):
        return F.when(c, 1).otherwise(0).cast("long")

    return per_key.groupBy("space").agg(
        F.sum(F.when(null, F.col("n_parent")).otherwise(0)).alias("nulls_parent"),
        F.sum(F.when(null, F.col("n_child")).otherwise(0)).alias("nulls_child"),
        F.sum(F.when(~null, one(now_p > 1) - one(was_p > 1)).otherwise(0)).alias("duplicates"),
        F.sum(F.when(~null, F.when(now_p <= 0, now_c).otherwise(0) - F.when(was_p <= 0, was_c).otherwise(0)).otherwise(0)).alias("orphans"),
    )


def _bring_up_to_date(spark: SparkSession, root: str) -> dict[str, dict[str, int]]:
    """Count what changed, commit it, and give the failure counts by space."""
    meta = TB.meta(spark, root, TB.CHECK_KEYS)
    seen, failures = meta.get("seen", {}), meta.get("failures", {})
    fresh = not all(_at_hand(spark, root, name, seen.get(name)) for name in CHECKED) or not TB.table_exists(spark, root, TB.CHECK_KEYS)
    if fresh:
        seen, failures = {}, {}
    versions = {name: _seen(SN.snapshot(spark, root, name)) for name in CHECKED}
    changes = key_changes(spark, root, seen)
    if changes is None:
        return failures
    path = staging_path(spark, "key-changes")
    try:
        changes.write.parquet(path)
        changes = spark.read.schema(STATE).parquet(path)
        if fresh:
            moved = failure_changes(changes, None).collect()  # three rows
            buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
        else:
            buckets = SN.snapshot(spark, root, TB.CHECK_KEYS).bucketed[1]
            with SN.bucketed_table(spark, root, TB.CHECK_KEYS) as state:
                moved = failure_changes(changes, state).collect()
        counts = {r["space"]: {c: r[c] + failures.get(r["space"], {}).get(c, 0) for c in r.asDict() if c != "space"} for r in moved}
        failures = {**failures, **counts}
        SN.write_snapshot(
            changes, root, TB.CHECK_KEYS, SN.OVERWRITE if fresh else SN.APPEND, (), {"seen": versions, "failures": failures}, (["space", "key"], buckets)
        )
    finally:
        SN.remove_path(spark, path)
    if len(SN.snapshot(spark, root, TB.CHECK_KEYS).live) >= MERGE_WRITES:
        _merge(spark, root)
    SN.collect_garbage(spark, root, TB.CHECK_KEYS)
    return failures


def _merge(spark: SparkSession, root: str) -> None:
    """One row a key again: the state's rows are added up where they lie."""
    old = SN.snapshot(spark, root, TB.CHECK_KEYS)
    with SN.bucketed_table(spark, root, TB.CHECK_KEYS) as state:
        sums = state.groupBy("space", "key").agg(F.sum("n_parent").alias("n_parent"), F.sum("n_child").alias("n_child"))
        kept = sums.filter("n_parent <> 0 OR n_child <> 0")
        SN.write_snapshot(kept, root, TB.CHECK_KEYS, SN.OVERWRITE, (), None, old.bucketed, hashed=True)


def run_checks_incremental(spark: SparkSession, root: str) -> DataFrame:
    """The ten declared tests over the written marts, as ``run_checks`` gives them, from the kept counts.

    Reads the partitions that changed since the last run and the counts of
    their keys; the first run, and one whose old versions are gone, reads all.
    """
    failures = _bring_up_to_date(spark, root)
    of = {(t, c): (s, p) for s, t, c, p in KEYS}
    rows = []
    for table, column, check in C.MART_CHECKS:
        space, parent = of[(table, column)]
        count = {"unique": "duplicates", "relationships": "orphans", "not_null": "nulls_parent" if parent else "nulls_child"}[check]
        n = failures.get(space, {}).get(count, 0)
        rows.append((table, column, check, n, n == 0))
    return spark.createDataFrame(rows, "table_name string, column_name string, check_name string, failures long, passed boolean")
