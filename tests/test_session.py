"""The session keeps what the submitter has set."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
from mercato.session import get_session
s = get_session("local[2]", **{"spark.ui.enabled": "false"})
print("KEYS", s.conf.get("spark.sql.shuffle.partitions"), s.conf.get("spark.sql.session.timeZone"), s.conf.get("spark.sql.adaptive.enabled"), s.sparkContext.getConf().get("spark.driver.memory"))
"""


def test_preset_keys_stay():
    args = "--driver-memory 1g --conf spark.sql.shuffle.partitions=4000 --conf spark.sql.session.timeZone=Europe/Berlin pyspark-shell"
    out = subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, env=os.environ | {"PYSPARK_SUBMIT_ARGS": args}, capture_output=True, text=True, timeout=120)
    assert "KEYS 4000 Europe/Berlin true 1g" in out.stdout, out.stdout + out.stderr[-2000:]


def test_queries_run_in_small_tasks(spark):
    """A task reads so many bytes at most, whatever the input; smaller settings stay."""
    from mercato.plans.catalog import all_queries
    from mercato.session import bounded_tasks

    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.openCostInBytes"]
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {k: spark.conf.get(k, None) for k in [*keys, first]}
    try:
        for k in before:
            spark.conf.unset(k)
        all_queries()["duplicate_report"](spark, "/root/testdata/sf0.001")
        assert [int(spark.conf.get(k)) for k in keys] == [32 << 20, 16 << 20, 512 << 10]
        assert int(spark.conf.get(first)) == 1000
        spark.conf.set(keys[0], "4m")
        spark.conf.set(first, "7")
        bounded_tasks(spark)
        assert spark.conf.get(keys[0]) == "4m" and spark.conf.get(first) == "7"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
