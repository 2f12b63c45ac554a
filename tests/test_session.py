"""Shared folder and shipped package."""

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest

from tests.conftest import ROOT, SF_SMALL
from txnguard.session import shared_dir

JOB = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.sql.session.timeZone", "UTC").getOrCreate())
import __spark_entry__ as E
print("ROWS", E.queries()["q15_stream_trailing_velocity"](spark, {SF_SMALL!r}).count())
"""


def test_python_workers_find_the_package_from_any_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", JOB], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1000" in run.stdout, run.stderr[-2000:]


def test_unset_shared_folder_is_an_error_on_a_cluster():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session)
