"""The working folder, in sessions of their own processes."""

import os
import subprocess
import sys

import pytest

CLUSTER = """
from pyspark.sql import SparkSession
from tidewright.session import shared_dir
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
try:
    print(shared_dir(spark))
except RuntimeError as told:
    print("told:", told)
"""
LOCAL = """
from tidewright.session import build_session, cut_lineage
spark = build_session(master="local[1]")
print("rows:", cut_lineage(spark.range(3)).count())
"""


@pytest.mark.parametrize("code, said", [(CLUSTER, "told: start the session with spark.checkpoint.dir"), (LOCAL, "rows: 3")])
def test_a_session_without_the_setting(tmp_path, code, said):
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.getcwd()}
    run = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert said in run.stdout, run.stderr[-2000:]
