import glob

import duckdb
import pytest

from claimlake.catalog import ORACLE_SQL, QUERIES
from tests.oracle import compare, rows


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, QUERIES[name], ORACLE_SQL[name], "/root/testdata/sf0.01") > 0


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLE_SQL.keys()))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() >= 0


SPLIT = [(1, "the of", "a"), (2, "the ### x\nof", "a"), (3, "the <nav> of", "b"), (4, None, "b"), (5, "dGhlIG9mIHRoZSBvZiB0aGUgb2Y=", "b")]


@pytest.mark.parametrize("name", ["pattern_matches", "screen_log_only"])
def test_patterns_that_only_the_preprocessed_text_has(spark, name, tmp_path):
    spark.createDataFrame(SPLIT, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "the of that")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    made = {t: sorted(glob.glob(f"{tmp_path}/{t}.parquet/*.parquet")) for t in ("documents", "benchmark")}
    con = duckdb.connect()
    for t, files in made.items():
        con.execute(f"create view {t} as select * from read_parquet({files})")
    result = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    df = QUERIES[name](spark, str(tmp_path))
    assert rows(df.columns, df.collect()) == rows(names, result.fetchall())
