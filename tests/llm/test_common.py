import pytest

from tracewell.llm import common


class Session:
    """Settings of a session."""

    def __init__(self, **conf):
        self.conf = self
        self.values = {k.replace("_", "."): v for k, v in conf.items()}

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_scratch_is_shared_or_local():
    assert common.shared_dir(Session(spark_master="local[4]"), "x").startswith("file:///")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session(spark_master="spark://host:7077"), "x")
    common._MADE.clear()


def test_clear_deletes_what_was_saved(spark):
    common._MADE.clear()
    common.saved(spark.range(3), "one")
    common.shared_dir(spark, "never-written")
    kept = spark.read.parquet(common._MADE[0]).count()
    assert kept == 3 and common.clear() == 1 and common.clear() == 0
