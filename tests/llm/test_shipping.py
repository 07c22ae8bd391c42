"""Python workers find the package wherever they start."""

import subprocess
import sys

SCRIPT = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .getOrCreate())
from ledgerlens.llm.bpe import encode_documents
docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
print("ROWS", encode_documents(docs).count())
"""


def test_workers_import_the_package_elsewhere(tmp_path):
    import os

    from tests.conftest import ROOT

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=300)
    assert "ROWS 2" in out.stdout, out.stderr[-2000:]
