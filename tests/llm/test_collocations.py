"""Phrases against a count of all of them in Python."""

import random
import re
from collections import Counter

import pytest

from spindle.llm import collocations

SCHEMA = "lang string, text string, phrase string, n long, words string"


def brute(rows, least, top, longest=5, percent=100):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cands = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    out = []
    for (lang, p), a in cands.items():
        longer = [b for (other, q), b in cands.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if any(100 * b >= percent * a for b in longer):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, score, a, " ".join(p), left, right))
    ranked = []
    for lang in {o[0] for o in out}:
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[1], -o[2], o[3].encode()))[:top]
        ranked += [(lang, i, phrase, a, left, right, n[lang], score) for i, (_, score, a, phrase, left, right) in enumerate(own, 1)]
    return sorted(ranked)


@pytest.fixture(scope="module")
def rows():
    """Short texts with every separator, nulls, empties, repeated rows, and one long text without an end of a piece."""
    r = random.Random(1)
    words = ["a", "B", "é", "漢", "x-y", "It's", "zz", "q", "#", "w1"]
    gaps = [" ", " ", "  ", "\t", ", ", ". ", "\n", "\x0b", "!?", " ", " "]
    out = [(r.choice(["en", "fr", None, "und"]), None if r.random() < 0.05 else "".join(r.choice(words) + r.choice(gaps) for _ in range(r.randint(0, 60)))) for _ in range(300)]
    return out + [out[5]] * 3 + [("", "a a a a a a"), ("en", " ".join(r.choice(words[:4]) for _ in range(8000)))]


@pytest.mark.parametrize("chunk, least, top, percent", [(1 << 24, 20, 2000, 100), (700, 20, 30, 60), (64, 3, 2000, 100)])
def test_phrases(spark, rows, chunk, least, top, percent):
    df = spark.createDataFrame([(lang, text, "p", 1, "w") for lang, text in rows], SCHEMA).repartition(3)
    got = sorted(tuple(x) for x in collocations.mine(df, least=least, top=top, percent=percent, chunk=chunk).collect())
    assert got == brute(rows, least, top, percent=percent) and got


def test_a_full_bit_table_changes_nothing(spark, rows, monkeypatch):
    """With far too few bits nearly all phrases pass in error; what is counted in vain stays below the bound."""
    monkeypatch.setattr(collocations, "BITS_EACH", 0)
    monkeypatch.setattr(collocations, "_has", lambda table, h: h == h)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(x) for x in collocations.mine(df, least=20).collect()) == brute(rows, 20, 2000)


def test_empty_tables_and_texts(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert collocations.mine(none).collect() == []
    blank = spark.createDataFrame([(None, None), ("en", ""), ("en", " \n.,"), ("en", "one")], "lang string, text string")
    assert collocations.mine(blank, least=1).collect() == []
    assert [x.phrase for x in collocations.mine(spark.createDataFrame([("en", "one two")], "lang string, text string"), least=1).collect()] == ["one two"]


def test_scores_beyond_64_bits(spark):
    big = [(7_000_000_000, 90_000_000_000_000, 7_000_000_003, 8_000_000_001), (100, 10, 3, 7), (5, 5, 5, 5)]
    got = spark.createDataFrame(big, "a long, n long, l long, r long").select(collocations.cut_score("a", "n", "l", "r")).collect()
    assert [x[0] for x in got] == [1000 * a * n // (left * right) for a, n, left, right in big]


def test_registered_query(spark):
    import __spark_entry__

    small = "/root/testdata/sf0.001"
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert sorted(tuple(x) for x in __spark_entry__.queries()["op11_phrases"](spark, small).collect()) == brute(rows, 100, 2000)
