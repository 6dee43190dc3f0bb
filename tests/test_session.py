"""The shared checkpoint folder: configured value first, private folder only in local mode."""

import pytest

from metrolens.session import checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, master, configured=None):
        self.master = master
        self.configured = configured
        self.current = None

    def getCheckpointDir(self):
        return self.current

    def getConf(self):
        return _Conf(self.configured)

    def setCheckpointDir(self, path):
        self.current = path


class _Session:
    def __init__(self, sc):
        self.sparkContext = sc


def test_configured_folder_is_used():
    sc = _Context("yarn", "hdfs://shared/checkpoints")
    assert checkpoint_dir(_Session(sc)) == "hdfs://shared/checkpoints"


def test_cluster_without_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session(_Context("spark://host:7077")))


def test_local_mode_gets_a_private_folder():
    sc = _Context("local[2]")
    path = checkpoint_dir(_Session(sc))
    assert path and sc.current == path


def test_shuffle_partitions_of_a_cluster_stay(monkeypatch):
    """A local master gets 8 partitions; any other keeps what the cluster set."""
    from metrolens import session

    seen = {}

    class Builder:
        def appName(self, name):
            return self

        def master(self, master):
            seen["master"] = master
            return self

        def config(self, key, value):
            seen[key] = value
            return self

        def getOrCreate(self):
            raise InterruptedError

    class Entry:
        builder = Builder()

    monkeypatch.setattr(session, "SparkSession", Entry)
    for master, expected in (("local[4]", "8"), ("yarn", None), (None, None)):
        seen.clear()
        with pytest.raises(InterruptedError):
            session.build_session(master)
        assert seen.get("spark.sql.shuffle.partitions") == expected
        assert seen.get("master") == master
    with pytest.raises(InterruptedError):
        session.build_session("yarn", extra_conf=session.cluster_conf(20e12, 4000))
    assert int(seen["spark.sql.shuffle.partitions"]) > 50_000


def test_staged_data_can_be_deleted(spark):
    import os

    from metrolens.session import clear_staging, materialize, staging_path

    df = materialize(spark.range(5).withColumnRenamed("id", "k"), "probe")
    assert df.dtypes == [("k", "bigint")] and df.count() == 5
    folder = os.path.dirname(staging_path(spark, "x")).removeprefix("file:")
    assert os.path.isdir(folder)
    assert clear_staging(spark) and not os.path.exists(folder)
    assert materialize(spark.range(3), "probe").count() == 3
