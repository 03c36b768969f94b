from types import SimpleNamespace

import pytest

from quillon.common import scratch, shared_folder


def session(master, conf=None, folder=None):
    conf = conf or {}
    sc = SimpleNamespace(master=master, getConf=lambda: conf, getCheckpointDir=lambda: folder)
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d: conf.get(k, d)))


def test_the_shared_folder_is_the_clusters():
    assert shared_folder(session("spark://host:7077", {"spark.checkpoint.dir": "hdfs://n/c/"})) == "hdfs://n/c"
    assert scratch(session("yarn", folder="s3a://b/c"), "x").startswith("s3a://b/c/x-")
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session(master))
    local = session("local[4]")
    assert shared_folder(local) == shared_folder(local)
