"""Declarative data tests: unique, not_null, relationships, and the mart suite.

Each ``check_*`` returns the offending rows lazily.  ``run_checks`` evaluates
the ten checks declared for the marts as one plan; ``plans.check_state`` keeps
the same counts up to date from what changed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanmart.sources import tables as TB


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` appearing more than once, with their counts (NULLs ignored).

    Counted with a partial aggregation before the shuffle, so a value held by
    a third of the rows is one row per map task, never one group in one task.
    """
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def check_relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL ``column`` has no match in ``parent``.

    The anti-join needs no ``distinct`` on the parent's keys, and without an
    aggregate between shuffle and join a hot key's partition can be split.
    """
    keys = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti").select(*child.columns)


def key_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n_records) for every non-NULL value: partial aggregation before the shuffle."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


# The declared mart tests, in declaration order.
MART_CHECKS = (
    ("fct_messages", "message_id", "unique"),
    ("fct_messages", "message_id", "not_null"),
    ("fct_messages", "channel_id", "not_null"),
    ("fct_messages", "channel_id", "relationships"),
    ("dim_channels", "channel_id", "unique"),
    ("dim_channels", "channel_id", "not_null"),
    ("fct_image_detections", "detection_id", "unique"),
    ("fct_image_detections", "detection_id", "not_null"),
    ("fct_image_detections", "message_id", "not_null"),
    ("fct_image_detections", "message_id", "relationships"),
)

_CHECK_COLS = ("table_name", "column_name", "check_name")


def _tagged(df: DataFrame, table: str, column: str, check: str, failures) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(check).alias("check_name"),
        failures.cast("long").alias("failures"),
    )


def run_checks(fct_messages: DataFrame, dim_channels: DataFrame, fct_image_detections: DataFrame) -> DataFrame:
    """The ten declared mart tests: table_name, column_name, check_name, failures, passed.

    Planned as one job with shared work:

    * every check emits failure contributions (NULL flags per row, one scan
      per table for all its not-null tests; one row
      per duplicated value, the row count of each orphan key); one grouped
      sum over their union -- partially aggregated inside each scan task --
      turns them into counts, so there is a single final shuffle;
    * each key column is counted per value once; the message-id and
      channel-id counts feed both the unique test and, as parent key sets,
      the relationship tests, and Spark reuses their shuffles;
    * child keys of a relationship are pre-aggregated before the left join,
      so a key held by a third of the rows is one row at the join.
    """
    fm, dc, fd = TB.FCT_MESSAGES, TB.DIM_CHANNELS, TB.FCT_IMAGE_DETECTIONS
    msg_ids = key_counts(fct_messages, "message_id")
    chan_ids = key_counts(dim_channels, "channel_id")
    det_ids = key_counts(fct_image_detections, "detection_id")

    def dups(counts, table, column):
        return _tagged(counts.filter(F.col("n_records") > 1), table, column, "unique", F.lit(1))

    def nulls(df, table, columns):
        # One scan per table: each row contributes a 0/1 per checked column.
        pairs = ", ".join(f"'{c}', CAST({c} IS NULL AS BIGINT)" for c in columns)
        flags = df.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, failures)")
        return flags.select(
            F.lit(table).alias("table_name"), "column_name", F.lit("not_null").alias("check_name"), "failures"
        )

    def orphans(child, column, parent_counts, table):
        per_key = key_counts(child, column)
        # n_records > 0 always holds; reading it keeps the parent side identical
        # to the unique test's aggregate, so its shuffle is reused.
        hits = parent_counts.select(column, (F.col("n_records") > 0).alias("_hit"))
        lost = per_key.join(hits, column, "left").filter(F.col("_hit").isNull())
        return _tagged(lost, table, column, "relationships", F.col("n_records"))

    spark = fct_messages.sparkSession
    zero = spark.createDataFrame([(*c, 0) for c in MART_CHECKS], [*_CHECK_COLS, "failures"])
    parts = [
        zero,
        dups(msg_ids, fm, "message_id"),
        nulls(fct_messages, fm, ["message_id", "channel_id"]),
        orphans(fct_messages, "channel_id", chan_ids, fm),
        dups(chan_ids, dc, "channel_id"),
        nulls(dim_channels, dc, ["channel_id"]),
        dups(det_ids, fd, "detection_id"),
        nulls(fct_image_detections, fd, ["detection_id", "message_id"]),
        orphans(fct_image_detections, "message_id", msg_ids, fd),
    ]
    totals = reduce(DataFrame.unionAll, parts).groupBy(*_CHECK_COLS).agg(F.sum("failures").alias("failures"))
    return totals.select(*_CHECK_COLS, F.col("failures").cast("long").alias("failures"), (F.col("failures") == 0).alias("passed"))
