"""A Python worker that stands still holds up no job: it is ended and its task run again."""

from __future__ import annotations

import os
import subprocess
import sys

from tradescribe.llm import tables

TOP = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Its first prediction never ends.
MODEL = """
import os
import time

import numpy as np


class Silent:
    languages = ("en",)

    def __init__(self, marker):
        self.marker = marker

    def probabilities(self, data, offsets):
        if not os.path.exists(self.marker):
            open(self.marker, "w").close()
            time.sleep(600)
        return np.ones((len(offsets) - 1, 1))
"""

# Tasks are run again under this master only.
JOB = """
import sys

from pyspark.sql import SparkSession

from silent_model import Silent
from tradescribe.llm import tables
from tradescribe.llm.subword_language import with_language

tables.SILENT_S = 4
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").getOrCreate()
docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)] + [(40, None)], "doc_id long, text string")
folder = sys.argv[1]
rows = with_language(docs.repartition(3, "doc_id"), Silent(f"{folder}/marker"), "doc_id")
rows.write.parquet(f"{folder}/rows")
"""


def test_silent_worker(spark, tmp_path):
    (tmp_path / "silent_model.py").write_text(MODEL)
    (tmp_path / "job.py").write_text(JOB)
    env = os.environ | {"PYTHONPATH": f"{TOP}:{tmp_path}", "PYSPARK_PYTHON": sys.executable, "PYSPARK_SUBMIT_ARGS": "pyspark-shell"}
    command = [sys.executable, str(tmp_path / "job.py"), str(tmp_path)]
    # The session's own settings stay out: a gateway of its parent would be used again.
    for name in ("PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET"):
        env.pop(name, None)
    done = subprocess.run(command, env=env, cwd=tmp_path, capture_output=True, text=True, timeout=90)
    assert done.returncode == 0, done.stderr[-2000:]
    assert (tmp_path / "marker").exists()
    rows = spark.read.parquet(f"{tmp_path}/rows").collect()
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in rows) == [(i, "en", 1.0) for i in range(40)] + [(40, "und", 0.0)]


def test_own_limit_stays(spark):
    names = (tables._SILENT_S, tables._END_SILENT)
    for name in names:
        spark.conf.unset(name)
    tables.ship_package(spark)
    assert [spark.conf.get(name) for name in names] == [str(tables.SILENT_S), "true"]
    try:
        spark.conf.set(names[0], "77")
        spark.conf.set(names[1], "false")
        tables.ship_package(spark)
        assert [spark.conf.get(name) for name in names] == ["77", "false"]
    finally:
        for name in names:
            spark.conf.unset(name)
