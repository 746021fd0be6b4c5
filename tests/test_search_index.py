import random
import re

import pytest

from tallyspark.sources import search_index as si

WORDS = "bath bomb fizzy lavender pack of set kit soap gift rose mint count piece case ünï".split()


def queue(spark, n):
    r = random.Random(6)
    rows = [(f"B{i:05d}", " ".join(r.choice(WORDS) for _ in range(r.randrange(1, 7))) + f" {r.randrange(60)}ct", i) for i in range(n)]
    rows += [(None, "Nameless Bath Bomb", -1), ("B99999", None, -2), rows[0], ("x", "", -3)]
    return spark.createDataFrame(rows, "asin string, title string, n int")


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    return si.build(queue(spark, 2000), f"{tmp_path_factory.mktemp('index')}/i", block_rows=100)


@pytest.mark.parametrize("word", [" Pack OF|ct$ ", "pack of", "^b0001", "rose.*mint", "(lavender|ünï) soap", "b00[0-9]12|nameless", "59ct$", "kit?", "", "zzz", "fizzy{2}", r"\bcase\b", "[", r"gift (?=set)"])
def test_rows_are_those_of_the_scan(spark, index, word):
    clean = word.strip().lower()
    try:
        re.compile(clean)
    except re.error:
        with pytest.raises(Exception, match="(?i)regex|pattern"):
            index.find(word).collect()
        return
    want = si.search(queue(spark, 2000), clean) if clean else queue(spark, 2000)
    key = lambda df: sorted(map(str, df.select("asin", "title", "n").collect()))
    got = index.find(word)
    assert got.columns == ["asin", "title", "n"] and key(got) == key(want)


def test_few_files_are_read(spark, index):
    total = len(index.queue().inputFiles())
    assert total >= 20
    read = lambda word: index.find(word)._jdf.queryExecution().executedPlan().toString()
    found = index.candidates("b00123")
    blocks = found.select("block").distinct().count()
    assert found.count() == 1 and blocks == 1 and "_block" in read("b00123")
    assert index.candidates("ct$") is None and index.candidates("nothing here").count() == 0


def test_what_an_expression_needs():
    assert si.needed("pack of|ct$") == [["pack of"], ["ct"]]
    assert si.needed("(a|bc)+def.g") == [["a", "def", "g"], ["bc", "def", "g"]]
    assert si.needed("(abc)?x*de{2,}") == [["d", "e"]]
    assert si.needed(r"\Qa\E") is None and si.needed("(") is None
    assert si.needed("(ax|by|cz|dx|ey)" * 3) is None  # too many ways
    assert si.trigrams("abcab") == ["abc", "bca", "cab"] and si.trigrams("ab") == []


def test_files_do_not_grow_with_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(si, "MAX_FILES", 10)
    rows = queue(spark, 2000)
    found = si.build(rows, f"{tmp_path}/i", block_rows=10)
    assert len(found.queue().inputFiles()) <= 11 and found.queue().select("_block").distinct().count() == 201
    assert sorted(map(str, found.find("b00123").collect())) == sorted(map(str, si.search(rows, "b00123").collect())) != []
