"""Where checkpoints go."""

import os
import subprocess
import sys

import pytest

from searchtide.session import checkpoint_folder

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_DIR = "/root/testdata/sf0.001"


class Session:
    """Just enough of a session to ask for a folder."""

    def __init__(self, master, settings):
        self.sparkContext = self
        self.conf = settings
        self.master = master
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_the_cluster_names_the_folder():
    session = Session("spark://host", {"spark.checkpoint.dir": "/shared/checkpoints"})
    assert checkpoint_folder(session) == session.folder == "/shared/checkpoints"


def test_a_folder_already_set_stays():
    session = Session("local[2]", {})
    session.folder = "/mine"
    assert checkpoint_folder(session) == session.folder == "/mine"


def test_local_mode_makes_its_own():
    session = Session("local[2]", {})
    assert "searchtide" in checkpoint_folder(session) and session.folder


def test_a_cluster_without_one_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_folder(Session("yarn", {}))


def test_real_session(spark):
    wanted = spark.conf.get("spark.checkpoint.dir")
    assert wanted in checkpoint_folder(spark)


LEAVES_NOTHING = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as contract
from pyspark.sql import SparkSession

builder = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
spark = builder.config("spark.sql.shuffle.partitions", "4"){more}.getOrCreate()
for name in ("csv_round_trip", "json_round_trip", "rank_user_keyword"):
    assert contract.queries()[name](spark, {sf!r}).count() > 0
"""


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("shared", [True, False])
def test_nothing_is_left_after_a_run(tmp_path, shared):
    folder, temporary = tmp_path / "shared", tmp_path / "tmp"
    folder.mkdir()
    temporary.mkdir()
    more = f'.config("spark.checkpoint.dir", "file://{folder}")' if shared else ""
    script = LEAVES_NOTHING.format(root=ROOT, more=more, sf=SF_DIR)
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env={**os.environ, "TMPDIR": str(temporary)},
        capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    tables = [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names]
    assert tables == []
    assert not list(temporary.glob("searchtide*"))
