"""Tasks must run on workers that do not have this package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from gaugeloom.functions.jsonflat import flatten_json
from gaugeloom.sources.documents import parse_json_docs
from gaugeloom.sources.lines import from_lines
df = spark.createDataFrame([('{{"a": {{"b": 1}}, "t": "x"}}', "m f=1i 5")], "doc string, line string").withColumn("collected_at", F.timestamp_micros(F.lit(0)))
assert list(df.select(flatten_json(F.col("doc")).alias("f")).first().f) == ["a_b"]
assert parse_json_docs(df, "j", ["t"]).metrics.first().tags == {{"t": "x"}}
assert from_lines(df).metrics.first().time_ns == 5
print("worker ok")
"""


def test_python_helpers_travel_with_the_task(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "worker ok" in out.stdout, out.stderr[-2000:]
