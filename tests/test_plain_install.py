"""A session whose configuration names no checkpoint folder, as on a fresh install."""

import os
import subprocess
import sys

SCRIPT = """
import sys
from chanmart.session import CHECKPOINT_CONF, checkpoint_dir, local_session, shared_folder, staging_path
spark = local_session(cores=2)
assert spark.conf.get(CHECKPOINT_CONF, None) is None
try:
    checkpoint_dir(spark)
    raise SystemExit("a missing folder must be an error")
except RuntimeError:
    pass
first = checkpoint_dir(spark, fallback=sys.argv[1])
assert first.startswith("file:") and sys.argv[1] in first, first
assert checkpoint_dir(spark) == first and staging_path(spark, "x").startswith(first)
spark.range(3).write.parquet(shared_folder(spark, "t"))
spark.range(3).checkpoint()
try:
    from chanmart.llm.common import prepare, staged
except ModuleNotFoundError:
    print("OK")
    raise SystemExit
prepare(spark)
assert staged(spark.range(5), "t").count() == 5
print("OK")
"""


def test_without_a_checkpoint_setting(scratch):
    conf = os.path.join(scratch, "empty-conf")
    os.makedirs(conf)
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_SUBMIT")}
    env |= {"SPARK_CONF_DIR": conf, "PYTHONPATH": os.pathsep.join([home, os.environ.get("PYTHONPATH", "")])}
    done = subprocess.run([sys.executable, "-c", SCRIPT, os.path.join(scratch, "ckpt")], env=env, cwd=scratch, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("OK"), done.stdout + done.stderr[-3000:]
