"""Executors without a copy of the package, and tables with awkward columns."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

import corpus_pipeline as cp

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"

PROBE = f"""
import sys
sys.path.insert(0, {ROOT!r})
from prepfold.session import local_session
import __spark_entry__ as se
spark = local_session(4, 4)
found = se.queries()
for name in sorted(n for n in found if n.startswith("op") or n == "pipeline"):
    found[name](spark, {SF!r}).write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
spark.stop()
"""


def test_workers_in_an_empty_folder(tmp_path):
    """Only the driver's path has the repository."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=tmp_path, env=env, capture_output=True, text=True,
                          timeout=900)
    ran = [line for line in done.stdout.splitlines() if line.startswith("ran ")]
    assert done.returncode == 0 and len(ran) == 14, done.stderr[-2000:]


def test_stages_keep_columns_of_any_name(spark):
    names = ["__row", "__toxicity", "a.b", "score", "row", "kept", "c0", "fp", "__TOXICITY_"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wide = docs.select("*", *[(F.col("doc_id") * 10 + k).alias(n) for k, n in enumerate(names)])
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns, name
        assert {r.doc_id for r in out.select("doc_id").collect()} == \
            {r.doc_id for r in stage(spark, docs, SF).select("doc_id").collect()}, name
        for row in out.collect():
            assert list(row)[-len(names):] == [row[0] * 10 + k for k in range(len(names))], name
