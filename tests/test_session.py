import os

import pytest

from stratum.session import shared_dir


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def __init__(self, master, checkpoint=None):
        self.master, self._ckpt = master, checkpoint

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, path):
        self._ckpt = path


class _Session:
    def __init__(self, master, conf):
        self.conf, self.sparkContext = _Conf(conf), _Context(master)


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(ValueError):
        shared_dir(_Session("yarn", {}))


def test_shared_folder_is_read_from_the_session():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt/"})
    assert shared_dir(s) == "hdfs:///shared/ckpt"


def test_local_mode_gets_a_folder_of_its_own():
    s = _Session("local[2]", {})
    path = shared_dir(s)
    assert os.path.isdir(path) and shared_dir(s) == path
    with pytest.raises(ValueError):
        shared_dir(_Session("local-cluster[2,1,1024]", {}))
