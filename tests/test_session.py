"""The shared folder: the running checkpoint folder, then the setting, else an error."""

import pytest

from scenecast import session


class Fake:
    """Just what the lookup reads of a session."""

    def __init__(self, running=None, setting=None):
        self.sparkContext = self
        self.conf = self
        self.running, self.setting = running, setting

    def getCheckpointDir(self):
        return self.running

    def get(self, key, default=None):
        return self.setting or default


def test_running_folder_comes_first():
    assert session.checkpoint_dir(Fake("hdfs://a/run/", "hdfs://b")) == "hdfs://a/run"
    assert session.checkpoint_dir(Fake(None, "hdfs://b/x")) == "hdfs://b/x"
    assert session.shared_dir(Fake(None, "hdfs://b"), "t").startswith("hdfs://b/t-")


def test_no_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Fake())


def test_session_folder_is_used(spark):
    base = session.checkpoint_dir(spark)
    assert session.shared_dir(spark, "x").startswith(base + "/x-")


def test_side_by_side_runs_jobs_with_the_callers_properties(spark):
    spark.sparkContext.setLocalProperty("scenecast.test", "mine")
    try:
        def task(n):
            assert spark.sparkContext.getLocalProperty("scenecast.test") == "mine"
            return spark.range(n).count()

        tasks = {f"n{n}": lambda n=n: task(n) for n in range(6)}
        want = {f"n{n}": n for n in range(6)}
        assert list(session.side_by_side(spark, tasks).items()) == list(want.items())
        assert session.side_by_side(spark, tasks, threads=1) == want
        assert session.side_by_side(spark, {}) == {}
    finally:
        spark.sparkContext.setLocalProperty("scenecast.test", None)


def test_side_by_side_raises_the_error_of_a_call(spark):
    def fails():
        raise KeyError("lost")

    with pytest.raises(KeyError, match="lost"):
        session.side_by_side(spark, {"good": lambda: 1, "bad": fails})
