"""Texts reach Python in pieces of bounded size, and none is lost."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spindle.functions import pieces
from spindle.functions.diff import line_diff, unified_diff
from spindle.operators import stats


def test_pieces_are_bounded_and_whole(monkeypatch):
    monkeypatch.setattr(pieces, "PIECE_BYTES", 10)
    texts = pa.array(["abcd", "é" * 3, None, "x" * 50, "", "ab", None, "y" * 10])
    got = list(pieces.pieces(texts))
    assert [a for a, _ in got] == [0, 3, 4, 7] and sum(n for _, n in got) == len(texts)
    assert list(pieces.pieces(texts.slice(1, 3), texts.slice(1, 3))) == [(0, 1), (1, 1), (2, 1)]
    assert pieces.by_pieces(pa.int64(), len, texts).to_pylist() == [4, 3, 0, 50, 0, 2, 0, 10]
    assert pieces.by_pieces(pa.int64(), len, texts.slice(0, 0)).to_pylist() == []


@pytest.mark.parametrize("rows", [1, 700])
def test_columns_over_many_pieces(spark, rows):
    """Ten kilobytes a row, so many pieces in one batch of rows."""
    df = spark.range(rows).repartition(1).select("id", F.concat(F.lit("a\nb\n"), F.repeat(F.lit("line\n"), 1000), F.col("id").cast("string")).alias("old"))
    df = df.withColumn("new", F.when(F.col("id") % 2 == 0, F.replace("old", F.lit("b\n"), F.lit("")))).withColumn("new", F.when(F.col("id") % 3 > 0, F.col("new")))
    out = stats.with_diff(df, "old", "new").withColumn("d", line_diff("old", "new")).withColumn("u", unified_diff("old", "new")).collect()
    assert sorted(r.id for r in out) == list(range(rows))
    for r in out:
        there = r.id % 2 == 0 and r.id % 3 > 0
        assert r.removed == (1 if there else 1003) and r.d.removed == r.removed and r.u.count("\n-") == r.removed


def test_an_extractor_sees_each_text_once(spark):
    df = spark.createDataFrame([("add a test",), (None,), ("",), ("x" * (1 << 20),), ("add a test",)], "t string")
    got = stats.verb_objects(df, "t", lambda t: [("say", str(len(t)))]).groupBy("object").count().collect()
    assert {r.object: r["count"] for r in got} == {"10": 2, "0": 2, str(1 << 20): 1}
