"""The library runs from another directory, and names its scratch folder."""

import os
import shutil
import subprocess
import sys
import tempfile

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
print("ROWS", E.queries()["daily_consumption"](spark, "/root/testdata/sf0.001").count())
"""


def test_driver_in_another_directory():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as cwd:
        out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
    assert int(out.stdout.split("ROWS")[1].split()[0]) > 0


@pytest.mark.parametrize("master,fine", [("local[4]", True), ("local", True), ("local-cluster[2,1,512]", False), ("yarn", False), ("spark://h:7077", False)])
def test_a_cluster_must_name_its_shared_folder(master, fine):
    from meterframe import session

    class Context:
        def __init__(self):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    Session.sparkContext = Context()
    if fine:
        assert session.ensure_checkpoint_dir(Session)
    else:
        with pytest.raises(RuntimeError):
            session.ensure_checkpoint_dir(Session)


def test_the_library_works_without_the_training_data_folders(tmp_path):
    """A copy without both llm folders keeps every metering query."""
    keep = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache")
    shutil.copytree(REPO, tmp_path / "copy", ignore=keep)
    script = "import __spark_entry__ as E; from meterframe.plans.registry import all_queries as q; print(set(E.queries()) == set(q()), 'pipeline' in E.queries(), len(E.oracle_sql()) == len(q()))"
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=300)
    assert out.stdout.split() == ["True", "False", "True"], out.stderr[-2000:]
