import os

import pytest

from clipfold.plans import cut, small


def test_cut_and_clear(spark):
    df = cut.cut(spark.range(5), "t")
    assert df.count() == 5 and "file" in df.inputFiles()[0]
    path = df.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    cut.clear(spark)
    assert not os.path.exists(path)


def test_small_sides_join_alike_whatever_their_size(spark):
    a, b = spark.range(20).selectExpr("id", "id % 3 k"), spark.createDataFrame([(0, "x"), (1, "y")], "k bigint, v string")
    want = sorted(map(tuple, a.join(b, "k", "left").collect()), key=str)
    for most in (50_000, 1):
        assert sorted(map(tuple, small.join_small(a, b, "k", "left", most).collect()), key=str) == want
    plan = small.join_small(a, b, "k")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://x:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        cut.shared_dir(Session())
