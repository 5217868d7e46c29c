"""The shared folder comes from the session; recommended settings are valid."""

from __future__ import annotations

import pytest

from fuelsight.session import cluster_conf, path_exists, remove_path, scratch_path, shared_dir, stream_conf


def test_shared_dir_is_the_contexts_checkpoint_folder(spark):
    folder = shared_dir(spark)
    assert folder == spark.sparkContext._jsc.sc().getCheckpointDir().get()
    assert spark.conf.get("spark.checkpoint.dir") in folder
    assert scratch_path(spark, "x").startswith(folder)


class _Context:
    """A session without a shared folder."""

    def __init__(self, master):
        self.master, self.chosen = master, None
        self.sparkContext = self._jsc = self
        self.conf = self

    def sc(self):
        return self

    def getCheckpointDir(self):
        chosen = self.chosen

        class Option:
            isEmpty = staticmethod(lambda: chosen is None)
            get = staticmethod(lambda: chosen)
        return Option

    def setCheckpointDir(self, path):
        self.chosen = path

    def get(self, key, default):
        return default


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        shared_dir(_Context("yarn"))
    with pytest.raises(RuntimeError):
        shared_dir(_Context("local-cluster[2,1,1024]"))
    assert shared_dir(_Context("local[4]"))


def test_staged_tables_are_removed(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(3).write.parquet(path)
    remove_path(spark, path)
    assert not path_exists(spark, path)


def test_stream_conf_has_few_state_stores():
    assert int(stream_conf(1000, 4)["spark.sql.shuffle.partitions"]) == 500


def test_cluster_conf_is_accepted(spark):
    conf = cluster_conf(executors=1000, cores_per_executor=4)
    assert conf["spark.sql.shuffle.partitions"] == "12000"
    sql_keys = {k: v for k, v in conf.items() if k.startswith("spark.sql.")}
    saved = {k: spark.conf.get(k, None) for k in sql_keys}
    try:
        for k, v in sql_keys.items():
            spark.conf.set(k, v)
            assert spark.conf.get(k) == v
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
