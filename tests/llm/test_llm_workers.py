"""Workers find all they need when the repository is on the driver's path only."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from shelfrank.llm.queries import QUERIES
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "4").getOrCreate()
for name in ("op1_repeated_passages", "op2_token_files", "op3_toxicity", "op4_nearest", "op5_bpe", "op6_license_scan",
             "op7_near_dedup", "op9_page_text"):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
print("all ran")
"""


def test_queries_run_from_another_folder(tmp_path):
    script = SCRIPT.format(repo=str(Path(__file__).parents[2]))
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=900)
    assert "all ran" in done.stdout, done.stderr[-3000:]
