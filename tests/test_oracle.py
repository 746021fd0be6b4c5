import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    want = con.execute(entry.oracle_sql()[name]).fetchall()
    names = [d[0] for d in con.description]
    got = entry.queries()[name](spark, DATA)
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(repr, want))
