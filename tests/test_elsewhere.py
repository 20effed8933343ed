"""Python workers need not find the packages: the entry module sends its functions by value."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SF_DIR = "/root/testdata/sf0.001"

SCRIPT = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
from speechloom.workspace import clear
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for key in ("word_alignment", "resample_waveforms", "transcribe"):
    print(key, entry.queries()[key](spark, {SF_DIR!r}).count())
    entry.queries()[key](spark, {SF_DIR!r}).write.format("noop").mode("overwrite").save()
clear(spark)
"""


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_runs_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(done.stdout.splitlines()) == 3
