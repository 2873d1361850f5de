"""Quickstart: the daily job end to end on the generated test tables.

    python examples/daily_job.py [SF_DIR] [WORK_DIR]

1. lands the messages of SF_DIR as a one-file-per-message JSON lake (from
   the executors), 2. loads it (each file once, bad files set aside),
3. loads the detections table, 4. builds staging and marts, 5. runs the ten
data tests, 6. prints the four reports.  Run it twice on the same WORK_DIR:
the second load adds nothing and the build is incremental.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chanmart.operators import reports as R  # noqa: E402
from chanmart.plans import jobs as P  # noqa: E402
from chanmart.session import checkpoint_dir, local_session  # noqa: E402
from chanmart.sources import fixtures as FX  # noqa: E402
from chanmart.sources import lake as LK  # noqa: E402
from chanmart.sources import tables as TB  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    work = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = local_session(app="chanmart-example")
    checkpoint_dir(spark, fallback=os.path.join(work, "checkpoints"))
    lake, root = os.path.join(work, "lake"), os.path.join(work, "warehouse")

    print("land", LK.write_message_files(FX.message_files(spark, sf_dir), lake))
    print("load", P.load_messages(spark, lake, root))
    if not TB.table_exists(spark, root, TB.RAW_IMAGE_DETECTIONS):
        TB.write_table(FX.raw_image_detections(spark, sf_dir), root, TB.RAW_IMAGE_DETECTIONS)
    P.build_marts(spark, root, as_of="2024-01-02")
    for row in P.run_mart_checks(spark, root).collect():
        print("check", json.dumps(row.asDict()))

    fct = TB.read_table(spark, root, TB.FCT_MESSAGES)
    dim = TB.read_table(spark, root, TB.DIM_CHANNELS)
    R.search_messages(fct, "the", limit=5).select("message_id", "channel_id", "message_posted_at").show()
    R.top_products_from_rollup(TB.read_table(spark, root, TB.RPT_WORD_COUNTS)).show()
    R.channel_activity_by_name(fct, dim, "Channel 1003").show()
    R.top_detected_objects(TB.read_table(spark, root, TB.FCT_IMAGE_DETECTIONS)).show()
    spark.stop()


if __name__ == "__main__":
    main()
