import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import common


def test_hidden_names_clash_with_nothing(spark):
    df = spark.createDataFrame([(1, 2, 3)], "_a int, __A int, b int")
    assert common.hidden(df, "_a", "b", "c", "c") == ["___a", "_b", "c", "_c"]


def test_released_tables_are_gone_but_for_what_is_kept(spark):
    first = common.materialize(spark.range(3), "old")
    mark = common.written()
    left, gone = common.materialize(spark.range(5), "left"), common.materialize(spark.range(7), "gone")
    folder = gone.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    common.release(spark, mark, keep=left)
    assert (first.count(), left.count()) == (3, 5) and not os.path.exists(folder)
    assert common.written() == mark + 1


def test_rewritten_tables_take_the_place_of_the_old(spark):
    other, old = common.materialize(spark.range(3), "other"), common.materialize(spark.range(5), "old")
    folder = old.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    new = common.rewrite(old.selectExpr("id + 1 AS id"), old, "new")
    assert (other.count(), sorted(r["id"] for r in new.collect())) == (3, [1, 2, 3, 4, 5]) and not os.path.exists(folder)


def test_small_batches_hold_few_long_texts(spark):
    """A task's batches end at a number of bytes, not at 10,000 rows; the session is as before afterwards."""
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)
    docs = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 4000).alias("text"))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    with common.small_batches(spark):
        found = [r["n"] for r in docs.mapInArrow(sizes, "n long").collect()]
    assert sum(found) > 12_000_000 and max(found) < common.BATCH_BYTES + 10_000 and spark.conf.get(key) == before
    spark.conf.set(key, "5000000")
    with pytest.raises(ValueError), common.small_batches(spark):
        raise ValueError
    assert spark.conf.get(key) == "5000000"
    spark.conf.unset(key)


def test_held_out_follows_the_ids(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "i long")
    got = {r["i"]: r["o"] for r in rows.select("i", common.held_out(rows.i, 7, 2).alias("o")).collect()}
    from tests.llm import brute

    assert got == {i: brute.out(i, 7, 2) for i in [*range(50), None]}


@pytest.mark.parametrize("text", [None, "", " \t", "a", "a\x0bb  c\n", "ÀB é\x1fz"])
def test_words(spark, text):
    from tests.llm import brute

    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(common.words(df.t).alias("w")).first()["w"] == brute.words(text)
