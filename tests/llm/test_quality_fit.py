"""The fit and the score of the registered quality query against one process over the same rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from spindle.llm import quality

SMALL = "/root/testdata/sf0.001"


def test_registered_query_equals_one_process(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rated = labels.select("doc_id", quality.grades().alias("grade"), F.xxhash64(F.lit(42), "doc_id").alias("place")).filter("grade is not null").collect()
    rated = sorted((r for r in rated if r.doc_id in texts), key=lambda r: (r.place, r.doc_id, r.grade))
    rows = [np.array(sorted(quality.features(texts[r.doc_id], {})), np.int64) for r in rated]
    want = quality.fit_arrays(rows, np.array([r.grade for r in rated]), least=4, least_z=6.0)
    model = quality.fit(docs, labels)
    assert model.thresholds == pytest.approx(want.thresholds) and model.weights.keys() == want.weights.keys()
    assert all(model.weights[k] == pytest.approx(v) for k, v in want.weights.items()) and want.weights
    got = {r.doc_id: r for r in __spark_entry__.queries()["op2_quality"](spark, SMALL).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        s = want.score(text, {})
        tails = [1 / (1 + math.exp(t - s)) for t in want.thresholds]  # P(grade > k)
        assert got[i].expected_grade == pytest.approx(sum(tails)) and got[i].p_top == pytest.approx(tails[-1]) and got[i].kept == (tails[-1] >= 0.5)
