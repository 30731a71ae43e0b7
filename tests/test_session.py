import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from hearth.session import shared_dir, scratch_path
from hearth.bindings import load_all
spark = SparkSession.builder.master("local[2]").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
d = shared_dir(spark)
assert d == shared_dir(spark) and scratch_path(spark, "x").startswith(d.replace("file:", ""))
assert load_all()["surrogate_key"].fn(spark, "/root/testdata/sf0.001").count() > 0
print("OK")
"""


def test_shared_dir_fallback_without_checkpoint_setting():
    """With no spark.checkpoint.dir (no spark-defaults), local runs still get a shared folder."""
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="hearth-noconf-"))
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], env=env, capture_output=True, text=True,
                         timeout=300)
    assert "OK" in out.stdout, out.stderr[-2000:]


def test_cluster_profile_and_defaults(spark):
    from hearth.session import CLUSTER_PROFILE, SESSION_DEFAULTS
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"
    assert SESSION_DEFAULTS["spark.sql.adaptive.enabled"] == "true"
    assert int(CLUSTER_PROFILE["spark.sql.shuffle.partitions"]) >= 1000


def test_scratch_is_removed_at_the_end(spark, monkeypatch):
    import os

    from hearth import session
    monkeypatch.setattr(session, "_RUN", "of-this-test")
    monkeypatch.setattr(session, "_roots", {})
    staged = session.stage(spark.range(5), "scratch_test")
    assert staged.count() == 5
    root = next(iter(session._roots))
    assert root.endswith("of-this-test") and os.listdir(root)
    session.release_scratch()
    assert not os.path.exists(root) and not session._roots
