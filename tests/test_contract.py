"""The entry file, loaded from another folder and under another name."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_DIR = "/root/testdata/sf0.001"

SCRIPT = """
import importlib.util
from pyspark.sql import SparkSession

spec = importlib.util.spec_from_file_location("some_name", {path!r})
contract = importlib.util.module_from_spec(spec)
spec.loader.exec_module(contract)
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4").getOrCreate()
)
for name in ("classify_function", "rank_user_keyword"):
    print(name, contract.queries()[name](spark, {sf!r}).count())
"""


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_from_elsewhere(tmp_path):
    script = SCRIPT.format(path=f"{ROOT}/__spark_entry__.py", sf=SF_DIR)
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300
    )
    counts = dict(line.split() for line in done.stdout.splitlines() if " " in line)
    assert done.returncode == 0, done.stderr[-3000:]
    assert int(counts["classify_function"]) > 100 and int(counts["rank_user_keyword"]) > 1000


def test_union_keeps_rows_without_a_time(spark, tmp_path):
    import __spark_entry__ as contract

    rows = [(1, "2024-01-02 00:00:00"), (2, None), (3, "2024-01-20 00:00:00")]
    events = spark.createDataFrame(rows, "event_id long, time string").selectExpr(
        "event_id", "to_timestamp_ntz(time) AS ts", "1L AS user_id", "'e' AS event_type",
        "1.0D AS value", "'' AS props",
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    found = contract.queries()["union_days"](spark, str(tmp_path)).select("event_id").collect()
    assert sorted(r[0] for r in found) == [1, 2, 3]
