"""Benchmark: load -> marts -> reports -> checks on the generated tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3).  Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Setup (untimed): the message tables are landed as a real lake, one JSON file
per message under telegram_messages/<date>/<channel>/<id>.json, and the
detections as the enrichment table.  Timed, each as the median of
BENCH_REPEAT runs after one warm-up:
  ingest_files      read the lake, validate, load once (fresh warehouse each run)
  ingest_daily      load only the newest day's folder into a warehouse holding the earlier days
  build_marts_daily, run_checks_daily    what that day changed: models, and checks from the kept counts
  ingest_nothing_new   list the lake and read nothing of it
  build_marts       staging + dim_channels + dim_dates + fct_messages + fct_image_detections, written
                    (full refresh)
  build_marts_incremental   the same after as_of moved one day (only affected partitions rebuilt)
  search_messages, top_products, channel_activity, channel_activity_by_name,
  top_detected_objects, run_checks    over the written marts
  search_messages_indexed, top_products_bounded   a rarer term through the skipping index; top words
                    from the heads of the partial counts
  top_products_rollup, channel_activity_rollup   the same two reports from the
                    per-lake-date partial counts the build keeps
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from chanmart.operators import reports as R  # noqa: E402
from chanmart.plans import check_state as CI  # noqa: E402
from chanmart.plans import jobs as P  # noqa: E402
from chanmart.plans import registered as Q  # noqa: E402
from chanmart.plans import search_index as SI  # noqa: E402
from chanmart.plans import top_words as TW  # noqa: E402
from chanmart.session import checkpoint_dir, local_session  # noqa: E402
from chanmart.sources import fixtures as FX  # noqa: E402
from chanmart.sources import lake as LK  # noqa: E402
from chanmart.sources import tables as TB  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def _sf_of(path: str) -> str:
    m = re.search(r"sf([0-9.]+)", path)
    return m.group(1) if m else path


def land_lake(spark, lake: str) -> int:
    """Write each fixture message as its own JSON file (the scraper's layout), from the executors."""
    return LK.write_message_files(FX.message_files(spark, SF_DIR), lake)["written"]


def timed(fn, repeat=REPEAT, warmup=True):
    if warmup:
        fn()
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t0)
    if os.environ.get("BENCH_VERBOSE"):
        print("runs", [round(r, 3) for r in runs], file=sys.stderr)
    return round(statistics.median(runs), 3)


def main() -> None:
    spark = local_session(app="chanmart-bench", cores=CPUS, shuffle_partitions=int(CPUS) * 2)
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    checkpoint_dir(spark, fallback=os.path.join(scratch, "checkpoints"))
    lake = os.path.join(scratch, "lake")
    n_files = land_lake(spark, lake)

    out: dict[str, float] = {}
    counter = {"i": 0}

    def ingest():
        counter["i"] += 1
        root = os.path.join(scratch, f"ingest-{counter['i']}")
        P.load_messages(spark, lake, root)

    out["ingest_files"] = timed(ingest)

    # Daily runs: the warehouse already holds every earlier day, loaded and
    # built (untimed setup); each run lists and loads one new day's folder and
    # builds what it changed.
    days = sorted(os.listdir(os.path.join(lake, LK.MESSAGES_FOLDER)))
    root_d = os.path.join(scratch, "daily")
    P.load_messages(spark, lake, root_d, dates=days[: -REPEAT - 1])
    P.build_marts(spark, root_d, days[-REPEAT - 2], full_refresh=True)
    CI.run_checks_incremental(spark, root_d)
    loads, builds, checks = [], [], []
    for day in days[-REPEAT - 1 :]:
        t0 = time.perf_counter()
        P.load_messages(spark, lake, root_d, dates=[day])
        t1 = time.perf_counter()
        P.build_marts(spark, root_d, day)
        t2 = time.perf_counter()
        CI.run_checks_incremental(spark, root_d).collect()
        loads.append(t1 - t0)
        builds.append(t2 - t1)
        checks.append(time.perf_counter() - t2)
    out["ingest_daily"] = round(statistics.median(loads[1:]), 3)
    out["build_marts_daily"] = round(statistics.median(builds[1:]), 3)
    out["run_checks_daily"] = round(statistics.median(checks[1:]), 3)
    # A run that finds nothing new: every file is listed, none is read.
    out["ingest_nothing_new"] = timed(lambda: P.load_messages(spark, lake, os.path.join(scratch, f"ingest-{counter['i']}")))

    root = os.path.join(scratch, "warehouse")
    P.load_messages(spark, lake, root)
    TB.write_table(FX.raw_image_detections(spark, SF_DIR), root, TB.RAW_IMAGE_DETECTIONS)
    out["build_marts"] = timed(lambda: P.build_marts(spark, root, Q.AS_OF, full_refresh=True))
    # Daily incremental build: as_of moves by one day each run, so one day of
    # messages enters (or leaves) the date spine and only its partitions are
    # rebuilt; staging is not re-parsed.
    toggle = {"i": 0}

    def incremental():
        toggle["i"] += 1
        P.build_marts(spark, root, ("2024-01-21" if toggle["i"] % 2 else Q.AS_OF))

    out["build_marts_incremental"] = timed(incremental, repeat=4, warmup=True)
    P.build_marts(spark, root, Q.AS_OF, full_refresh=True)

    fct = TB.read_table(spark, root, TB.FCT_MESSAGES)
    dim = TB.read_table(spark, root, TB.DIM_CHANNELS)
    det = TB.read_table(spark, root, TB.FCT_IMAGE_DETECTIONS)
    words = TB.read_table(spark, root, TB.RPT_WORD_COUNTS)
    days = TB.read_table(spark, root, TB.RPT_CHANNEL_DAYS)
    reports = {
        "search_messages": lambda: R.search_messages(fct, Q.SEARCH_TERM).collect(),
        "top_products": lambda: R.top_products(fct).collect(),
        "channel_activity": lambda: R.channel_activity(fct, Q.CHANNEL_ID).collect(),
        "channel_activity_by_name": lambda: R.channel_activity_by_name(fct, dim, Q.CHANNEL_NAME).collect(),
        "top_detected_objects": lambda: R.top_detected_objects(det).collect(),
        "search_messages_indexed": lambda: SI.search_messages_indexed(spark, root, Q.RARE_TERM).collect(),
        "top_products_bounded": lambda: TW.top_products_bounded(spark, root).collect(),
        "top_products_rollup": lambda: R.top_products_from_rollup(words).collect(),
        "channel_activity_rollup": lambda: R.channel_activity_from_rollup(days, Q.CHANNEL_ID).collect(),
        "run_checks": lambda: P.run_mart_checks(spark, root).collect(),
    }
    for name, fn in reports.items():
        out[name] = timed(fn)

    rows = {
        "messages": TB.read_table(spark, root, TB.FCT_MESSAGES).count(),
        "detections": det.count(),
        "chars": fct.agg(F.sum("message_length")).first()[0],
    }
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": round(sum(out.values()), 3),
                "unit": "sec",
                "queries": out,
                "sf": _sf_of(SF_DIR),
                "cpus": int(CPUS),
                "repeat": REPEAT,
                "input": {"files": n_files, **rows},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
