"""Where a session runs and where it keeps its intermediate files."""

import os
import subprocess
import sys

import pytest

from starload import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return None if self.folder is None else self.folder

    def setCheckpointDir(self, d):
        self.folder = d

    def getConf(self):
        return {}


class _Session:
    def __init__(self, master):
        self.sparkContext = _Context(master)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_checkpoint_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_Session(master))


def test_a_local_session_gets_a_folder():
    assert os.path.isdir(session.checkpoint_root(_Session("local[2]")))


def test_the_submitted_master_and_settings_stay():
    code = "from starload.session import build_session as b; s = b(); print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=77 --conf spark.ui.enabled=false pyspark-shell", "PYTHONPATH": ROOT}
    out = subprocess.run([sys.executable, "-c", code], env=env, cwd=ROOT, capture_output=True, text=True, timeout=120).stdout
    assert "GOT local[2] 77" in out
