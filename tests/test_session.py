import os

import pytest

from gridlark import session


class Conf:
    def __init__(self, **values):
        self.conf = self
        self.values = {k.replace("_", "."): v for k, v in values.items()}

    def get(self, name, default=None):
        return self.values.get(name, default)


def test_clusters_need_a_shared_folder():
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.scratch_folder(Conf(spark_master=master))
        assert session.scratch_folder(Conf(spark_master=master, spark_checkpoint_dir="hdfs://x/y")).startswith("hdfs://x/y/")
    assert os.path.isabs(session.scratch_folder(Conf(spark_master="local[4]")))


def test_stored_folders_can_be_released(spark):
    with session.released(spark):
        df = session.stored(spark.range(5))
        (path,) = {f.rsplit("/", 1)[0].removeprefix("file://") for f in df.inputFiles()[:1]}
        assert df.count() == 5 and os.path.isdir(path)
    assert not os.path.exists(path)
