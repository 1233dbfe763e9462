"""The shared work folder: read from the session, invented only for local tests."""

from __future__ import annotations

import pytest

from visitflow.session import checkpoint_root


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, checkpoint_dir=None, conf=None):
        self.master = master
        self._dir = checkpoint_dir
        self._conf = _Conf(conf or {})

    def getCheckpointDir(self):  # noqa: N802 - SparkContext API
        return self._dir

    def setCheckpointDir(self, path):  # noqa: N802 - SparkContext API
        self._dir = path

    def getConf(self):  # noqa: N802 - SparkContext API
        return self._conf


class _Session:
    def __init__(self, sc):
        self.sparkContext = sc


def test_uses_directory_already_set():
    sc = _Context("yarn", checkpoint_dir="hdfs://namenode/checkpoints/app")
    assert checkpoint_root(_Session(sc)) == "hdfs://namenode/checkpoints/app"


def test_uses_configured_shared_folder():
    sc = _Context("k8s://x", conf={"spark.checkpoint.dir": "file:///shared/checkpoints"})
    assert checkpoint_root(_Session(sc)) == "file:///shared/checkpoints"
    assert sc.getCheckpointDir() == "file:///shared/checkpoints"


def test_refuses_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session(_Context("spark://master:7077")))


def test_local_tests_get_a_private_folder():
    sc = _Context("local[4]")
    path = checkpoint_root(_Session(sc))
    assert path and sc.getCheckpointDir() == path
