import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spindle.functions.code_tokens import code_token_list, split_edit_prompt
from spindle.functions.text import hash_int, py_strip, seeded, split_identifier, splitlines, word_tokens
from spindle.sources.jsonl import edit_prompt_text

ODD = ["", " ", "a", " a\t", "\x1c a \x1f", "a\nb\r\nc\rd", "a\n", "\n\n", "x y z", "\x0b\x0c\x1d", "é 漢\x85"]


def one_column(spark, values, **columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r for r in df.select("i", *[c.alias(n) for n, c in columns.items()]).orderBy("i").collect()]


def test_strip_and_lines(spark):
    for v, r in zip(ODD, one_column(spark, ODD, strip=py_strip("s"), lines=splitlines("s"))):
        assert r.strip == v.strip() and list(r.lines) == v.splitlines()


def test_identifiers_and_words(spark):
    names = ["camelCase", "snake_case", "HTTPServer", "__init__", "a1B2", "two words_here"]
    got = [list(r.p) for r in one_column(spark, names, p=split_identifier("s"))]
    assert got == [["camel", "Case"], ["snake", "case"], ["HTTPServer"], ["init"], ["a1B2"], ["two", "words", "here"]]
    texts = ["Don't stop, Été!", "", "a_b  -- C3"]
    want = [[w for w in (re.sub(r"[^\w]", "", x).lower() for x in re.split(r"\s+", t)) if w] for t in texts]
    assert [list(r.w) for r in one_column(spark, texts, w=word_tokens("s"))] == want


def test_code_tokens():
    assert code_token_list("def fooBar(self):\n    return my_var + HTTPServer") == ["def", "foo", "bar", "(", "self", ")", ":", "return", "my", "var", "+", "httpserver"]
    assert code_token_list("") == []


def test_edit_prompt_split(spark):
    rows = [("```python\nx = 1\n```", "do it"), (" plain ", ""), ("## Instruction: inside", "y")]
    df = spark.createDataFrame(rows, "c string, i string")
    code, instruction = split_edit_prompt(edit_prompt_text(F.col("c"), F.col("i")))
    got = [tuple(r) for r in df.select(code, instruction).collect()]
    assert got == [("x = 1", "do it"), ("plain", ""), ("", "inside\n## Instruction:\ny")]
    none = spark.createDataFrame([("no markers",)], "c string").select(*split_edit_prompt(F.col("c"))).first()
    assert tuple(none) == ("", "")


def test_ranks_do_not_depend_on_partitions(spark):
    df = spark.range(200).withColumn("r", seeded(1, "id")).withColumn("k", hash_int(F.col("r"), F.lit(7)))
    assert sorted(df.collect()) == sorted(df.repartition(9).collect())
    assert all(0 <= r.k < 7 for r in df.collect())


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\r\x1c ", max_size=8), min_size=1, max_size=20))
def test_strip_property(spark, values):
    for v, r in zip(values, one_column(spark, values, strip=py_strip("s"), lines=splitlines("s"))):
        assert r.strip == v.strip() and list(r.lines) == v.splitlines()
