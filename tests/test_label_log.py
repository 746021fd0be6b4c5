import pytest

from tallyspark.operators import labels as lab
from tallyspark.sources import commits, label_log


def labels(spark, *rows):
    return spark.createDataFrame([(a, "pure", v, None, "", note, ts) for a, v, note, ts in rows], lab.SCHEMA)


def notes(spark, top):
    return {r["asin"]: r["notes"] for r in label_log.read(spark, top).collect()}


def test_appends_and_crashes_between_steps(spark, tmp_path):
    top = f"{tmp_path}/store"
    assert label_log.read(spark, top).count() == 0 and label_log.read(spark, top).columns == [c.split()[0] for c in lab.SCHEMA.split(", ")]
    assert label_log.append(labels(spark, ("a", "true", "old", 5.0), ("b", "true", "kept", 5.0), (None, "true", "nameless", 9.0)), top) == 1
    label_log.append(labels(spark, ("a", "false", "new", 5.0), ("b", "false", "earlier", 4.0), ("c", "true", "added", 1.0)), top)
    assert notes(spark, top) == {"a": "new", "b": "kept", "c": "added"}
    # A crash after the segment is written, and one after the pointer's file is, before its rename.
    label_log.stage(labels(spark, ("a", "true", "lost", 99.0)), top, 3)
    (tmp_path / "store" / commits.FOLDER / ".half").write_text("segment-x\n")
    assert notes(spark, top) == {"a": "new", "b": "kept", "c": "added"}
    assert label_log.append(labels(spark, ("d", "true", "later", 1.0)), top) == 3
    assert notes(spark, top) == {"a": "new", "b": "kept", "c": "added", "d": "later"}
    assert len(label_log.vacuum(spark, top, keep=1)) == 1 and notes(spark, top)["d"] == "later"


def test_an_append_writes_its_own_labels_only(spark, tmp_path):
    top = f"{tmp_path}/store"
    label_log.append(labels(spark, *[(f"k{i}", "true", "n", 1.0) for i in range(500)]), top)
    before = set(commits.names(spark, top))
    label_log.append(labels(spark, ("k1", "true", "one", 2.0)), top)
    (new,) = set(commits.names(spark, top)) - before
    assert spark.read.parquet(f"{top}/{new}").count() == 1 and notes(spark, top)["k1"] == "one"


def test_two_writers(spark, tmp_path, monkeypatch):
    top, asked = f"{tmp_path}/store", []
    label_log.append(labels(spark, ("a", "true", "first", 1.0)), top)
    number = commits.version

    def late(s, t):  # another commit between this writer's look and its own
        found = number(s, t)
        if len(asked) < 1:
            asked.append(1)
            assert commits.put(s, t, found + 1, [*commits.read(s, t, found), label_log.stage(labels(spark, ("b", "true", "other", 1.0)), t, found + 1)])
        return found

    monkeypatch.setattr(commits, "version", late)
    assert label_log.append(labels(spark, ("c", "true", "mine", 1.0)), top) == 3
    monkeypatch.undo()
    assert notes(spark, top) == {"a": "first", "b": "other", "c": "mine"}
    assert not commits.put(spark, top, 2, ["x"]) and commits.read(spark, top, 2) != ["x"]


def test_compaction_keeps_the_newest(spark, tmp_path):
    top = f"{tmp_path}/store"
    for i in range(4):
        label_log.append(labels(spark, ("a", "true", f"note {i}", 1.0), (f"k{i}", "true", "own", 1.0)), top, compact=3)
    assert len(label_log.segments(spark, top)) == 2  # of the third append one segment was made, the fourth is beside it
    assert notes(spark, top) == {"a": "note 3"} | {f"k{i}": "own" for i in range(4)}
    assert label_log.append(labels(spark), top) == 6 and len(notes(spark, top)) == 5
    label_log.vacuum(spark, top)
    assert len(notes(spark, top)) == 5


@pytest.mark.parametrize("name", ["_current", "store"])
def test_no_store(spark, tmp_path, name):
    assert commits.version(spark, f"{tmp_path}/{name}") == 0 and commits.read(spark, f"{tmp_path}/{name}") == []
