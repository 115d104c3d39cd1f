import os
import subprocess
import sys

import pytest

from vellum import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return {}


class _Session:
    def __init__(self, master):
        self.sparkContext = _Context(master)
        self.conf = {}


@pytest.mark.parametrize("master", ["spark://h:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session(master))


def test_workers_find_the_package_from_any_folder(tmp_path):
    """A Python worker that is started elsewhere, without the repository on its path, runs the workbook reader."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as E
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("ROWS", E.queries()["workbook_folder"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1500" in out.stdout, out.stderr[-1500:]
