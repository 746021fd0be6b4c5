from types import SimpleNamespace

import pytest

from tallyspark.sources.stage import mark, release, shared_dir, staged


def session(master, folder=None):
    none = SimpleNamespace(isDefined=lambda: False)
    conf = SimpleNamespace(get=lambda key, default: folder, set=lambda key, value: None)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none))))


def test_a_cluster_needs_a_shared_folder():
    assert shared_dir(session("yarn", "hdfs:///tmp/x")) == "hdfs:///tmp/x"
    assert shared_dir(session("local[4]")).startswith("file://")
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="checkpoint"):
            shared_dir(session(master))


def test_staged_rows_are_read_back(spark):
    df = spark.range(9).selectExpr("id", "id % 2 = 0 AS even")
    assert staged(df, "test").dtypes == df.dtypes and staged(df, "test").count() == 9


def test_staged_tables_are_released(spark):
    kept = staged(spark.range(3), "kept")
    since = mark()
    gone = staged(spark.range(4), "gone")
    assert gone.count() == 4
    release(spark, since)
    assert mark() == since and kept.count() == 3
    with pytest.raises(Exception, match="(?i)exist|not found"):
        spark.read.parquet(gone.inputFiles()[0]).count()
