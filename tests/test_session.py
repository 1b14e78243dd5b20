"""The checkpoint folder comes from the session; a local folder is chosen
only in local mode."""

from __future__ import annotations

import pytest

from trendstats.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, current=None, conf=None):
        self.master = master
        self.current = current
        self.conf = _Conf(conf or {})

    def getCheckpointDir(self):
        return self.current

    def getConf(self):
        return self.conf

    def setCheckpointDir(self, folder):
        self.current = folder


class _Session:
    def __init__(self, master, current=None, conf=None):
        self.sparkContext = _Context(master, current, conf)
        self.conf = _Conf(conf or {})


def test_existing_folder_is_kept():
    s = _Session("yarn", current="hdfs:///ckpt/app-1")
    assert ensure_checkpoint_dir(s) == "hdfs:///ckpt/app-1"


def test_folder_from_session_setting():
    s = _Session("k8s://cluster", conf={"spark.checkpoint.dir": "s3a://bucket/ckpt"})
    assert ensure_checkpoint_dir(s) == "s3a://bucket/ckpt"
    assert s.sparkContext.getCheckpointDir() == "s3a://bucket/ckpt"


def test_cluster_without_setting_refuses_local_folder():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("yarn"))


def test_local_mode_gets_a_temp_folder():
    s = _Session("local[4]")
    folder = ensure_checkpoint_dir(s)
    assert "trendstats-ckpt-" in folder and s.sparkContext.getCheckpointDir() == folder
