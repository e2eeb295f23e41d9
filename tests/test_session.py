from types import SimpleNamespace

import pytest

from ringledger.session import shared_folder


def stub(master, folder):
    conf = SimpleNamespace(get=lambda key, default: folder)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_folder_of_the_cluster_is_used():
    a, b = (shared_folder(stub("yarn", "hdfs:///shared/")) for _ in range(2))
    assert a.startswith("hdfs:///shared/ringledger/") and a != b


def test_without_a_setting_only_a_local_session_gets_a_folder():
    assert "ringledger-" in shared_folder(stub("local[4]", None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(stub("yarn", None))


def test_setting_of_the_session(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
