import os
from types import SimpleNamespace

import pytest

from andenlake import session


def test_a_cluster_without_a_shared_folder_is_an_error():
    def fake(master, folder=None):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: folder),
            sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_folder(fake(master))
        assert session.shared_folder(fake(master, "/shared/")) == "/shared"


def test_scratch_tables_are_removed(spark):
    session.clear_scratch(spark)
    table = session.written(spark.range(3), "probe")
    assert table.count() == 3
    path = table.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and session.clear_scratch(spark) == 1
    assert not os.path.exists(path) and session.clear_scratch(spark) == 0
