import random

import pytest
from pyspark.sql import functions as F

from tallyspark.sources import records as rec

CELLS = ["", "plain", 'say ""hi""', "a,b", "line\nbreak", "two\n\nbreaks", '""', "é🙂", "x" * 60, "crlf\r\nwithin", '\n"",\n', "  spaced ", "5' 6"]


def table(seed, n, end="\n"):
    r = random.Random(seed)
    quoted = lambda c: f'"{c}"' if any(x in c for x in ',"\n\r') or r.random() < 0.3 else c
    cell = lambda: quoted(r.choice(CELLS))
    rows = [[f"k{i}", cell(), cell(), cell()] for i in range(n)]
    return "".join(",".join(x) + end + ("" if r.random() < 0.95 else end) for x in [["id", "one", '"t,w""o"', "three"], *rows])


def whole(spark, path):
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.columns, sorted(plain(r) for r in df.collect())


def plain(row):
    # The one-task reader makes line breaks within quotes like those of the file; here they stay.
    return repr(tuple(row)).replace(r"\r\n", r"\n")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_splits_of_any_size_equal_one_task(spark, tmp_path, end):
    path = f"{tmp_path}/a b.csv"
    with open(path, "w", newline="") as f:
        f.write(table(3, 300, end))
    columns, want = whole(spark, path)
    for split in (1 << 20, 4000, 701, 97):
        got = rec.read_csv(spark, path, split)
        assert got.columns == [*columns, "pos"]
        found = got.orderBy("pos").collect()
        assert sorted(plain(r[:-1]) for r in found) == want, split
        assert [r["id"] for r in found] == [f"k{i}" for i in range(300)]  # places are in the file's order, with no gap
        assert [r["pos"]["row"] for r in found] == list(range(300))
    assert rec.lines_of(spark, path, 4000).rdd.getNumPartitions() >= 4
    # States that are too many to broadcast are joined to the lines.
    assert sorted(plain(r[:-1]) for r in rec.read_csv(spark, path, 701, max_ranges=3).collect()) == want


def test_every_small_split(spark, tmp_path):
    text = 'id,v\n1,"a\nb"\n2,"c""\n"\n3,d"e\n\n4,"f\r\ng"\r\n5,"never\nends'
    path = f"{tmp_path}/s.csv"
    with open(path, "w", newline="") as f:
        f.write(text)
    for split in (3, 5, 8, 13):
        got = [tuple(r) for r in rec.read_csv(spark, path, split).orderBy("pos").select("id", "v").collect()]
        assert got[:4] == [("1", "a\nb"), ("2", 'c"\n'), ("3", 'd"e'), ("4", "f\r\ng")], split
        assert len(got) == 5 and got[4][0] == "5"


def test_no_task_gets_the_whole_file(spark, tmp_path):
    path = f"{tmp_path}/big.csv"
    with open(path, "w", newline="") as f:
        f.write(table(5, 4000))
    cut = rec._cut(rec.lines_of(spark, path, 20_000), rec.entered(rec.ranges_of(rec.lines_of(spark, path, 20_000))), True)
    sizes = [r["n"] for r in cut.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.length("text")).alias("n")).collect()]
    assert len(sizes) >= 8 and max(sizes) <= 20_500


def test_folders_and_files_of_nothing(spark, tmp_path):
    for name, text in (("b", 'id,v\n3,"x\ny"\n'), ("a", "id,v\n1,\n2\n"), ("c", "")):
        (tmp_path / f"{name}.csv").write_text(text)
    got = rec.read_csv(spark, str(tmp_path), 6).orderBy("pos")
    assert [tuple(r)[:2] for r in got.collect()] == [("1", None), ("2", None), ("3", "x\ny")]
    empty = rec.read_csv(spark, f"{tmp_path}/c.csv")
    assert empty.columns == ["pos"] and empty.count() == 0


def test_the_state_of_a_line():
    cases = [("a,b", True, False), ('a,"b', False, True), ('"a","b"', True, True), ('a"b,c', True, True), ('""', True, False), ('"""', False, True), ('x",y"z', True, True), ('x","y', False, False), ("", True, False)]
    for line, start, within in cases:
        assert (rec.closes(line, False), rec.closes(line, True)) == (start, within), line
    assert rec.closes('"' * 200_001 + "," * 100_000, True) in (True, False)  # linear


def test_tasks_do_not_grow_with_ranges(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,t\n" + "".join(f'{i},"x\n{i}"\n' for i in range(3000)))
    assert len(rec.lines_of(spark, f"{tmp_path}/a.csv", 256).select("start").distinct().collect()) > 100
    assert rec.lines_of(spark, f"{tmp_path}/a.csv", 256).rdd.getNumPartitions() <= max(rec.FEW_TASKS, spark.sparkContext.defaultParallelism)
    assert [r["t"] for r in rec.read_csv(spark, f"{tmp_path}/a.csv", 256).orderBy("pos.row").collect()] == [f"x\n{i}" for i in range(3000)]
