"""The shared scratch folder comes from the session; a cluster session
without ``spark.checkpoint.dir`` is refused rather than given a folder on
one machine's disk."""

import pytest

from sluice.session import ensure_checkpoint_dir


class _Context:
    def __init__(self, master, current=None):
        self.master, self._dir = master, current

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d


class _Conf:
    def get(self, key, default=None):
        return default


class _Session:
    def __init__(self, master, current=None):
        self.sparkContext, self.conf = _Context(master, current), _Conf()


def test_cluster_session_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("spark://head:7077"))
    assert ensure_checkpoint_dir(_Session("yarn", "hdfs:///shared/ckpt")) == "hdfs:///shared/ckpt"


def test_local_session_gets_a_scratch_folder():
    s = _Session("local[4]")
    assert ensure_checkpoint_dir(s) == s.sparkContext.getCheckpointDir()
