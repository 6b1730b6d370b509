"""Bags of words move each text once, not the rows of its bag."""

import duckdb

from spindle import queries

D = "/root/testdata/sf0.001"


def test_bags_are_counted_where_they_are_made(spark):
    plan = queries.bag_of_words(spark, D)._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(dealt) == 1 and "term" not in dealt[0]


def test_bags_equal_their_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{D}/documents.parquet'")
    for name in ("bag_of_words", "bag_of_word_ids"):
        got = queries.QUERIES[name](spark, D)
        want = sorted(con.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.SQL[name]})").fetchall())
        assert sorted(map(tuple, got.collect())) == want


def test_equal_ids_have_one_bag(spark, tmp_path):
    rows = [(1, "a b a", "x"), (2, "b", "x"), (1, "a c", "x"), (3, None, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, queries.bag_of_words(spark, str(tmp_path)).collect())) == [(1, "a", 3), (1, "b", 1), (1, "c", 1), (2, "b", 1)]
