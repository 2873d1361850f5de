"""Command line: the daily job and the report queries.

    python -m chanmart load    --lake LAKE --root WAREHOUSE
    python -m chanmart stream  --lake LAKE --root WAREHOUSE --checkpoint DIR
    python -m chanmart enrich  --images IMAGES --root WAREHOUSE --detector pkg.mod:factory
    python -m chanmart build   --root WAREHOUSE [--as-of YYYY-MM-DD] [--full-refresh]
    python -m chanmart test    --root WAREHOUSE
    python -m chanmart run     --lake LAKE --root WAREHOUSE [--images IMAGES --detector ...] [--as-of ...]
    python -m chanmart report  --root WAREHOUSE search QUERY | top-products [N] | activity CHANNEL_NAME
                               | top-objects [N]

Under spark-submit, the session comes from the cluster configuration; run
locally it starts a ``local[*]`` session.  Report rows are printed as JSON
lines (reports are top-k or per-day results, so they are small).
"""

from __future__ import annotations

import argparse
import importlib
import json
import os
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    """The running session, or a new one from the submit configuration (local[*] by default).

    The web UI stays off unless CHANMART_UI=1.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName("chanmart")
    if os.environ.get("CHANMART_UI") != "1":
        builder = builder.config("spark.ui.enabled", "false")
    return builder.getOrCreate()


def _detector(spec: str):
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def _print_rows(df) -> None:
    for row in df.collect():
        print(json.dumps(row.asDict(), default=str, ensure_ascii=False))


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="chanmart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load")
    p.add_argument("--lake", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--dates", help="comma-separated yyyy-MM-dd folders to read (default: all)")
    p = sub.add_parser("stream")
    p.add_argument("--lake", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--checkpoint", required=True)
    p = sub.add_parser("enrich")
    p.add_argument("--images", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--detector", required=True, help="module:callable returning a detector")
    p.add_argument("--dates", help="comma-separated yyyy-MM-dd folders to read (default: all)")
    p = sub.add_parser("build")
    p.add_argument("--root", required=True)
    p.add_argument("--as-of")
    p.add_argument("--full-refresh", action="store_true")
    p = sub.add_parser("test")
    p.add_argument("--root", required=True)
    p = sub.add_parser("run")
    p.add_argument("--lake", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--images")
    p.add_argument("--detector")
    p.add_argument("--as-of")
    p.add_argument("--dates", help="comma-separated yyyy-MM-dd folders to read (default: all)")
    p = sub.add_parser("report")
    p.add_argument("--root", required=True)
    p.add_argument("name", choices=["search", "top-products", "activity", "top-objects"])
    p.add_argument("arg", nargs="?")
    args = ap.parse_args(argv)

    from chanmart.operators import reports as R
    from chanmart.plans import jobs as P
    from chanmart.plans.search_index import search_messages_indexed
    from chanmart.plans.top_words import top_products_bounded
    from chanmart.sources import tables as TB

    spark = _session()
    dates = getattr(args, "dates", None)
    dates = [d.strip() for d in dates.split(",") if d.strip()] if dates else None
    if args.cmd == "load":
        print(json.dumps(P.load_messages(spark, args.lake, args.root, dates=dates)))
    elif args.cmd == "stream":
        from chanmart.streaming.ingest_stream import ingest_stream

        ingest_stream(spark, args.lake, args.root, args.checkpoint).awaitTermination()
    elif args.cmd == "enrich":
        print(json.dumps(P.enrich_images(spark, args.images, args.root, _detector(args.detector), dates=dates)))
    elif args.cmd == "build":
        print(json.dumps(P.build_marts(spark, args.root, args.as_of, full_refresh=args.full_refresh)))
    elif args.cmd == "test":
        checks = P.run_mart_checks(spark, args.root)
        rows = checks.collect()  # ten rows
        for r in rows:
            print(json.dumps(r.asDict()))
        return 0 if all(r["passed"] for r in rows) else 1
    elif args.cmd == "run":
        detector = _detector(args.detector) if args.detector else None
        result = P.run_pipeline(spark, args.lake, args.images, args.root, detector, args.as_of, dates=dates)
        print(json.dumps(result, default=str))
        return 0 if all(c["passed"] for c in result["checks"]) else 1
    elif args.cmd == "report":
        fct = TB.read_table(spark, args.root, TB.FCT_MESSAGES)
        if args.name == "search":
            _print_rows(search_messages_indexed(spark, args.root, args.arg or ""))
        elif args.name == "top-products":
            n = int(args.arg or R.TOP_LIMIT)
            if TB.table_exists(spark, args.root, TB.RPT_PERIOD_WORDS):
                _print_rows(top_products_bounded(spark, args.root, n))
            else:  # a warehouse built without rollups: count from the facts
                _print_rows(R.top_products(fct, n))
        elif args.name == "activity":
            try:
                _print_rows(R.channel_activity_by_name(fct, TB.read_table(spark, args.root, TB.DIM_CHANNELS), args.arg))
            except KeyError as exc:
                print(json.dumps({"error": str(exc)}), file=sys.stderr)
                return 2
        elif args.name == "top-objects":
            det = TB.read_table(spark, args.root, TB.FCT_IMAGE_DETECTIONS)
            _print_rows(R.top_detected_objects(det, int(args.arg or R.TOP_LIMIT)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
