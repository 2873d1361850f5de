"""Session helpers: conf the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def allow_duplicate_json_keys(spark: SparkSession) -> None:
    """Let the JSON parser keep the last of repeated keys instead of failing."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for ``checkpoint()``, read from the session.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    (tests, local runs) is ``fallback`` used.  The setting is one of Spark's
    own and can't be changed on a running session, so the fallback is
    registered with the SparkContext and read back from there.
    """
    context = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path and not context.getCheckpointDir() and fallback is None:
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set and no fallback folder was given")
    if not context.getCheckpointDir():
        context.setCheckpointDir(path or fallback)
    return path or context.getCheckpointDir()


def importable_in_workers(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed (they start from the JVM's environment)."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([home, *paths])


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Set SQL confs for the actions run inside the block, then restore them.

    File-scan confs are read when an action plans its scan, so they must be
    in place while the job's actions run, not only when frames are built.
    """
    previous = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in previous.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for an intermediate table.

    Used to write a batch once and read it back (cutting its lineage), where
    every executor and a restarted driver can see it.
    """
    import uuid

    return os.path.join(checkpoint_dir(spark), "chanmart", f"{name}-{uuid.uuid4().hex}")


def shared_folder(spark: SparkSession, name: str) -> str:
    """As ``staging_path``, for callers without a checkpoint folder too: local runs get a temporary one."""
    local = spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="chanmart-") if local and not named else None)
    return staging_path(spark, name)


def local_session(app: str = "chanmart", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests, the bench and examples (UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CHANMART_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
