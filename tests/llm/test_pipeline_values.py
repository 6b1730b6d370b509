"""Odd rows through the stages of the pipeline, compared by value: repeated rows, null ids, an id with several texts."""

import random
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from spindle.llm import mix_sources
from spindle.llm.encode import tokenizer_path

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, __copies long"


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(4)
    words = lambda n: " ".join(f"w{r.randrange(5000)}" for _ in range(n))
    a, b, c = words(60), words(40), words(50)
    item = next(x.text for x in spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").collect() if len((x.text or "").split()) > 20)
    leak = f"{words(20)} {item} {words(20)}"
    made = {"a": [(1, a)] * 400 + [(2, a), (3, a + " end"), (None, a)], "b": [(2, b)], "c": [(None, c), (5, "")], "d": [(6, None), (7, leak), (7, "kept beside it")]}
    return [(i, t, None, s, None, 9) for s, own in made.items() for i, t in own], a, b, c, leak


def test_stages(spark, rows):
    every, a, b, c, leak = rows
    df = spark.createDataFrame(every, DOCS).repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    said = lambda d: Counter((x.doc_id, x.text) for x in d.collect())
    unique = stages["near_dedup"](spark, df, SMALL)
    want = Counter({(1, a): 400, (None, a): 1, (2, b): 1, (None, c): 1, (5, ""): 1, (6, None): 1, (7, leak): 1, (7, "kept beside it"): 1})
    assert said(unique) == want and unique.columns == df.columns
    unique = spark.createDataFrame(unique.collect(), DOCS)
    clean = stages["decontamination"](spark, unique, SMALL)
    del want[7, leak]
    assert said(clean) == want
    clean = spark.createDataFrame(clean.collect(), DOCS)
    mixed = stages["mixing"](spark, clean, SMALL)
    got = said(mixed)
    assert set(got) <= set(want)
    taken = {(x.doc_id, x.source): 0 for x in clean.collect()}
    for x in mix_sources.mix(clean).collect():
        taken[x.doc_id, x.source] += x.copies
    copies = Counter((x.doc_id, x.source) for x in mixed.collect())
    assert {k: n for k, n in taken.items() if n} == dict(copies)
    mixed = spark.createDataFrame(mixed.collect(), DOCS)
    t = Tokenizer.from_file(tokenizer_path())
    tokens = stages["token_ids"](spark, mixed, SMALL).collect()
    assert Counter((x.doc_id, x.n_tokens) for x in tokens) == Counter({(i, len(t.encode(x or "", add_special_tokens=False).ids) + 1): 0 for i, x in got}) + Counter([(i, len(t.encode(x or "", add_special_tokens=False).ids) + 1) for (i, x), n in got.items() for _ in range(n)])
    assert sorted(x.start for x in tokens)[0] == 0


def test_stages_of_nothing(spark, rows):
    df = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, df, SMALL).collect() == [], name
