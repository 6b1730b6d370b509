import difflib
import io
import contextlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spindle import queries, schemas
from spindle.functions.code_tokens import CODE_STOP_WORDS, code_token_list
from spindle.functions.diff import diff_counts, register
from spindle.functions.phrases import verb_object_pairs
from spindle.functions.text import seeded
from spindle.operators import balance, extract, finetune, generate, mix, seeds, stats, topics
from spindle.operators.topics import TopicModel
from spindle.plans import jobs, pipelines
from spindle.sources import jsonl, sinks, templates

FENCE = "```"


def response(old="[Program Before Edit]\n" + FENCE + "\na\nb\n" + FENCE, desc="[Descriptive]\nlong", lazy="[Lazy]\nshort", end=""):
    return f"{old}\n{desc}\n{lazy}{end}"


def separated(spark, one, two="[Program After Edit]\nc\nd"):
    return extract.separate_sections(spark.createDataFrame([(one, two)], "response_1 string, response_2 string")).first()


def test_sections(spark):
    r = separated(spark, response())
    assert (r.code_before, r.instruct_descriptive, r.instruct_lazy, r.code_after, r.reason) == (FENCE + "\na\nb\n" + FENCE, "long", "short", "c\nd", None)
    for end in ("\n### more", "\n--- x", f"\n{FENCE} x", "[Program Before Edit]"):
        assert separated(spark, response(end=end)).instruct_lazy == "short"
    two_spellings = separated(spark, response(old="### Program Before Edit\nx\n### [Program Before Edit]\ny\nz"))
    assert two_spellings.code_before == "y\nz"
    assert separated(spark, response(desc="none")).reason == "missing_mark"
    assert separated(spark, response(lazy="[Lazy]\n---")).reason == "empty_section"
    assert separated(spark, response(old="[Program Before Edit]")).reason is None  # empty old code isn't rejected here
    out_of_order = separated(spark, "[Lazy]\ns\n[Descriptive]\nd\n[Program Before Edit]\no")
    assert out_of_order.code_before == "" and out_of_order.reason == "empty_section"
    assert separated(spark, None).reason == "missing_mark"


def purified(spark, *texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r.p for r in df.select("i", extract.purified_code(F.col("s"), **options).alias("p")).orderBy("i").collect()]


def test_fences(spark):
    f = FENCE
    assert purified(spark, "none", f"{f}markdown\nm\n{f}\n{f}py\nx\n{f}", f"{f}markdown\nm\n{f}", f"{f}\nx\n{f}", f"{f}\npython\nx\n{f}", f"{f}\npython_x = 1\ny\n{f}", f"{f}\n \n{f}", f"{f}\nopen", None) == [None, "x", "m", "x", "x", "y", None, None, None]
    assert purified(spark, f"{f}\npython_x = 1\ny\n{f}", strict_lang_line=True) == ["python_x = 1\ny"]
    assert purified(spark, f"{f}js\nx\n{f}", keep_language_mark=True) == ["## js\nx"]


def test_single_lines_and_trim(spark):
    df = spark.createDataFrame([(0, "one"), (1, "a\nb"), (2, "a\n─"), (3, " \n$ ls\nx"), (4, None), (5, FENCE + "\none\n" + FENCE)], "i int, code_before string")
    assert {r.i for r in extract.filter_single_line(df, ("code_before",)).collect()} == {1, 4, 5}
    t = spark.createDataFrame([("-`*# \nx\t \n",)], "s string").select(extract.purified_instruction(F.col("s"))).first()[0]
    assert t == "x\t"


def test_extraction_is_one_narrow_plan(spark):
    df = spark.createDataFrame([(response(), "[Program After Edit]\nc\nd")], "response_1 string, response_2 string")
    good, bad = pipelines.extract_triplets(df)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        good.explain()
    assert "Exchange" not in out.getvalue() and "Python" not in out.getvalue()
    assert good.count() == 1 and bad.count() == 0
    assert pipelines.extract_triplets(df, drop_unpurified=True)[0].count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdef"), max_size=40), st.lists(st.sampled_from("abcdef"), max_size=40))
def test_diff_counts(a, b):
    old, new = "\n".join(a), "\n".join(b)
    added, removed, modified, hunks, unified = diff_counts(old, new)
    a, b = old.splitlines(), new.splitlines()
    ops = difflib.SequenceMatcher(None, a, b).get_opcodes()
    assert modified == sum(max(j - i, m - k) for t, i, j, k, m in ops if t == "replace")
    assert (added, removed) == tuple(sum(max(j - i, m - k) for t, i, j, k, m in ops if t == s) for s in ("insert", "delete"))
    assert unified == sum(line.startswith("@@") for line in difflib.unified_diff(a, b))
    assert unified == hunks if a != b else hunks == (0 < len(a) <= 6)


def test_diff_edges_and_filter(spark):
    line = lambda n, *cut: "\n".join(f"l{i}" for i in range(n) if i not in cut)
    assert diff_counts(line(6), line(6))[3] == 1 and diff_counts(line(7), line(7))[3] == 0 and diff_counts("", "") == (0,) * 5
    assert diff_counts(line(20), line(20, 3, 10))[3] == 1 and diff_counts(line(20), line(20, 3, 11))[3] == 2
    junk = [*("x" if i % 3 else f"u{i}" for i in range(300))]
    assert diff_counts("\n".join(junk), "\n".join(["new", *junk]))[2] + diff_counts("\n".join(junk), "\n".join(["new", *junk]))[0] >= 1
    rows = [(0, line(100), line(100, *range(70))), (1, line(100), line(100, *range(71))), (2, line(5), line(5)), (3, None, "a"), (4, line(100), line(100, *range(0, 63, 9))), (5, line(100), line(100, *range(0, 64, 8)))]
    df = spark.createDataFrame(rows, "i int, code_before_purify string, code_after_purify string")
    assert {r.i for r in stats.filter_by_diff(df).collect()} == {0, 3, 4}
    register(spark)
    assert spark.sql("select line_diff('a\nb', 'a').removed as r").first().r == 1


def brute_fill(sizes, total):
    if sum(sizes) <= total:
        return sizes
    target, locked = [0] * len(sizes), set()
    while True:
        share = (total - sum(sizes[i] for i in locked)) / (len(sizes) - len(locked))
        new = {i for i, s in enumerate(sizes) if s <= share} - locked
        if not new:
            break
        locked |= new
    rest, open_ = total - sum(sizes[i] for i in locked), [i for i in range(len(sizes)) if i not in locked]
    for k, i in enumerate(open_):
        target[i] = rest // len(open_) + (k < rest % len(open_))
    return [sizes[i] if i in locked else target[i] for i in range(len(sizes))]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=8), st.integers(1, 200))
def test_water_fill(spark, sizes, total):
    df = spark.createDataFrame([(f"g{i}", s, i) for i, s in enumerate(sizes)], "g string, size long, first_row long")
    got = {r.first_row: r.target for r in balance.water_fill(df, total, "g").collect()}
    assert [got[i] for i in range(len(sizes))] == brute_fill(sizes, total)


def test_balanced_sample(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else None if i % 2 else f"g{i % 5}") for i in range(900)], "i long, g string")
    a = balance.balance_by_group(df, "g", "i", total=100)
    assert a.count() == 100 and sorted(a.collect()) == sorted(balance.balance_by_group(df.repartition(11), "g", "i", total=100).collect())
    assert balance.balance_by_group(df, "g", "i", total=5000).count() == 900
    assert {r["count"] for r in balance.balance_by_group(df, "g", "i", per_group=7).groupBy("g").count().collect()} == {7}
    with pytest.raises(ValueError):
        balance.balance_by_group(df, "g", "i")


def test_largest_remainder():
    assert mix.largest_remainder([1 / 3] * 3, 100) == [34, 33, 33]
    assert mix.largest_remainder([0.5, 0.5], 60_000) == [30_000, 30_000]
    for bad in ([0.5, 0.4], [2.0, -0.5]):
        with pytest.raises(ValueError):
            mix.largest_remainder(bad, 10)


def test_largest_remainder_of_many_groups(spark, tmp_path):
    """More groups than rows to share out, and a null one."""
    rows = [(i, None if i == 0 else f"l{i % 1500:04d}") for i in range(4499)]
    spark.createDataFrame(rows, "doc_id long, lang string").write.parquet(f"file://{tmp_path}/documents.parquet")
    got = {r.lang: r.target for r in queries.QUERIES["largest_remainder"](spark, f"file://{tmp_path}").collect()}
    assert len(got) == 1501 and sum(got.values()) == 1000
    assert {k for k, n in got.items() if n} == {f"l{i:04d}" for i in range(1, 1001)}


def test_mixing(spark):
    rows = [(i, ["a", "b"], ["s"], "old", "new", "" if i == 0 else "d", "l") for i in range(10)]
    df = spark.createDataFrame(rows, "row_id long, commit array<string>, code_snippet array<string>, code_before_purify string, code_after_purify string, instruct_descriptive_purify string, instruct_lazy_purify string")
    got = mix.sample_and_mix([df, df], ["descriptive", "lazy"], ["m", None], [0.5, 0.5], 20, 1).collect()
    assert len(got) == 19 and {r.instr_type for r in got} == {"m_descriptive", "unknown_lazy"} and got[0].commit == "a,b"
    for args in (([df], ["other"], [None], [1.0]), ([df], ["lazy"], [None, None], [1.0]), ([df], ["lazy"], [None], [0.9])):
        with pytest.raises(ValueError):
            mix.sample_and_mix(*args, 5, 1)
    with pytest.raises(Exception, match="rows to sample"):
        mix.sample_and_mix([df], ["lazy"], [None], [1.0], 11, 1).collect()


def test_records(spark):
    df = spark.createDataFrame([("c", "o", "n", "i", None)], "commit string, code_before_purify string, code_after_purify string, instruct_purify string, instr_type string")
    r = finetune.format_records(df, no_thinking_tag=True).first()
    assert [m.role for m in r.messages] == ["system", "user", "assistant"] and r.instr_type == "unknown"
    assert r.messages[1].content.endswith("## Code After:\n /no_think") and r.messages[2].content == FENCE + "python\nn\n" + FENCE
    assert finetune.format_records(df, "alpaca").columns[:3] == ["instruction", "system", "output"]
    both = df.select(finetune.edit_prompt(F.lit("a"), F.lit("b"), F.lit("c"), "py", "js")).first()[0]
    assert both == f"## Code Before:\n{FENCE}py\na\n{FENCE}\n## Instruction:\nb\n## Code After:\n{FENCE}js\nc\n{FENCE}"
    with pytest.raises(ValueError):
        finetune.format_records(df, "other")


COMMITS = "commit string, old_contents string, new_contents string, message string"


def test_seeds(spark):
    text = "\n".join(f"line {i}" for i in range(30))
    rows = [(f"c{i}", text if i else "short", "new", "m") for i in range(6)] + [("bad", "", "x", "m"), ("nul", text, None, "m")]
    commits = spark.createDataFrame(rows, COMMITS)
    shots = spark.createDataFrame([("p", "d", "l"), ("q", "e", "k")], "code_before string, instruct_descriptive string, instruct_lazy string")
    got = seeds.create_prompts(commits, shots, 50, 3).collect()
    assert len(got) == 50 and sorted(got) == sorted(seeds.create_prompts(commits.repartition(5), shots, 50, 3).collect())
    for r in got:
        assert r.commit[0] != r.commit[1] and set(r.commit) <= {f"c{i}" for i in range(1, 6)}
        assert all(5 <= len(s.splitlines()) <= 15 and s in text and s in r.user[0] for s in r.code_snippet)
    with pytest.raises(ValueError):
        seeds.create_prompts(commits.limit(1), shots, 1, 3).collect()
    with pytest.raises(ValueError):
        seeds.create_prompts(commits, shots, 1, 3, "v5.9")
    again = seeds.rewrite_prompts(commits, shots, 3, shuffle=True).collect()
    assert {r.commit for r in again} == {f"c{i}" for i in range(6)} and all("+new" in r.user for r in again)
    with pytest.raises(ValueError):
        templates.get_prompts("v9")


def test_topics(spark):
    df = spark.createDataFrame([(i, ["a", "b"] * 3 if i % 2 else ["x", "y"] * 3) for i in range(20)] + [(99, [])], "i long, tokens array<string>")
    one, two = (sorted(topics.TopicModel.fit(df, k=3, iterations=5).assign(df).select("i", "topic").collect()) for _ in range(2))
    assert one == two and len(one) == 21 and {r.i: r.topic for r in one}[99] == -1
    with pytest.raises(ValueError):
        topics.TopicModel.fit(df.filter("i = 99"))
    assert topics.TopicModel.fit(df, k=3, iterations=2).describe(2).count() == 3


def test_topics_use_all_words_and_documents(spark, monkeypatch):
    """Words beyond the vocabulary count, unknown ones give -1, and the fit draws from all documents."""
    rows = [(i, ["the"] * 4 + [f"{'ab'[i % 2]}{j}" for j in range(9)] * 3) for i in range(40)] + [(98, ["a1", "a2"]), (99, [])]
    df = spark.createDataFrame(rows, "i long, tokens array<string>")
    m = topics.TopicModel.fit(df, k=2, iterations=2, vocabulary=1)
    bags = m.words.transform(df.withColumn("__names", topics._names(df, m.words, "tokens"))).collect()
    assert all(r["__bag"].toArray().sum() == len(r.tokens) for r in bags)
    assert {r.i: r["__bag"].numNonzeros() for r in bags if r.i > 97} == {98: 2, 99: 0}
    assert all((r.topic >= 0) == (r.i != 99) for r in m.assign(df).collect())
    full = topics.TopicModel.fit(df, k=2, iterations=1)
    assert [r.topic for r in full.assign(spark.createDataFrame([(1, ["unheard"])], df.schema)).collect()] == [-1]
    made, real = [], topics.LDA
    monkeypatch.setattr(topics, "LDA", lambda **options: made.append(options) or real(**options))
    queries.QUERIES["topic_assign_lda"](spark, "/root/testdata/sf0.001")
    assert (made[0]["k"], made[0]["maxIter"], made[0]["subsamplingRate"]) == (20, 20, 1.0)


def test_topic_cache(spark, tmp_path):
    df = spark.createDataFrame([(i, [f"t{i % 3}", "u"]) for i in range(12)], "i long, tokens array<string>")
    a = topics.cached_fit(df, f"file://{tmp_path}", k=2, iterations=2)
    b = topics.cached_fit(df, f"file://{tmp_path}", k=2, iterations=2)
    assert sorted(a.assign(df).select("i", "topic").collect()) == sorted(b.assign(df).select("i", "topic").collect())
    topics.cached_fit(df.filter("i > 0"), f"file://{tmp_path}", k=2, iterations=2)
    assert len(list(tmp_path.iterdir())) == 2


def test_dt_filter(spark):
    code = "\n".join(f"name_{i} = {i}" for i in range(8))
    rows = [(i, f"{code}\nextra_{i}", code, f"remove the line number {i % 4} of topic") for i in range(30)]
    df = spark.createDataFrame(rows, "i long, code_before_purify string, code_after_purify string, instruct_purify string")
    config = jsonl.FilterConfig.of({"jsonl_path": "x", "field_name": "f", "data_format": "general", "random_seed": 1, "filter_settings": {"max_samples_total": 10}})
    assert (config.max_modify_lines, config.max_hunk_num, config.field_name) == (70, 7, ["f"])
    each = jsonl.FilterConfig.of({"jsonl_path": "x", "field_name": ["f"], "data_format": "general", "filter_settings": {"max_samples_per_topic": 2}})
    by_code = df.withColumn("g", F.col("i") % 4)
    assert pipelines.group_balanced(by_code, "g", "i", each).count() == 8
    out = pipelines.dt_filter(df, config, "i", k=3, iterations=3)
    assert out.count() == 10 and out.columns == df.columns


def test_histogram_and_pairs(spark):
    df = spark.createDataFrame([(x,) for x in (0, 4, 5, 10, 20)], "x long")
    assert [(r.bin_start, r.n) for r in stats.histogram(df, "x", 5).orderBy("bin_start").collect()] == [(0, 2), (5, 1), (10, 1), (15, 1)]
    assert stats.histogram(df.limit(0), "x", 5).collect() == []
    counts = spark.createDataFrame([("v", f"o{i}", 10 - i) for i in range(5)] + [("w", "o", 1)], "verb string, object string, count long")
    assert {(r.verb, r.object, r["count"]) for r in stats.top_pairs(counts, 1, 2, drop_other=False).collect()} == {("v", "o0", 10), ("v", "o1", 9), ("v", "<other>", 21)}
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        stats.top_pairs(counts, 1, 2).explain()
    assert "WindowGroupLimit" in out.getvalue()
    said = spark.createDataFrame([("Add the tests. Remove code!",)], "t string")
    assert {tuple(r) for r in stats.verb_objects(said, "t").collect()} == {("add", "tests"), ("remove", "code")}


def test_generation(spark):
    df = spark.createDataFrame([(1, "s", ["a", "b"]), (2, "s", ["a", " "]), (3, None, ["c"])], "request_id long, system string, user array<string>")
    got = {(r.request_id, r.sample_index): r for r in generate.generate(df, num_completion=2).collect()}
    assert set(got) == {(1, 1), (1, 2), (3, 1), (3, 2)} and len(got[1, 1].response) == 2 and got[1, 1].error is None
    done = spark.createDataFrame([(1, 1), (1, 1), (3, 2)], "request_id long, sample_index int")
    assert {(r.request_id, r.sample_index) for r in generate.generate(df, num_completion=2, done=done).collect()} == {(1, 2), (3, 1)}
    with pytest.raises(ValueError):
        generate.generate(df, "unknown")

    class Flaky:
        calls = 0

        def complete(self, *a):
            Flaky.calls += 1
            if Flaky.calls < 3:
                raise RuntimeError("busy")
            return "ok"

    assert generate.converse(Flaky(), "s", ["x"], 0.8, 0.95, 10, 5, 0) == (["ok"], None)
    Flaky.calls = -9
    assert generate.converse(Flaky(), "s", ["x"], 0.8, 0.95, 10, 2, 0) == ([], "RuntimeError: busy")


def test_sources(spark, tmp_path):
    p = tmp_path / "in.jsonl"
    p.write_text('{"commit": "[x]", "user": ["a"]}\n\n{"commit": ["a", "b"], "user": "u"}\n')
    got = jsonl.read_polymorphic(spark, f"file://{p}", "other string", ("commit", "user")).collect()
    assert [(list(r.commit), list(r.user)) for r in got] == [(["[x]"], ["a"]), (["a", "b"], ["u"])]
    q = tmp_path / "bad.jsonl"
    q.write_text("{broken\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|fail"):
        jsonl.read_jsonl(spark, f"file://{q}", "a string").collect()
    m = spark.createDataFrame([("c", [("user", "a"), ("assistant", "x"), ("user", "b")])], "commit string, m array<struct<role:string,content:string>>")
    assert jsonl.load_instructions(m, "m", "sharegpt").first().instruction == "a\nb"
    bad = spark.createDataFrame([("c", [("assistant", "x")])], m.schema)
    with pytest.raises(Exception, match="no user turn"):
        jsonl.load_instructions(bad, "m", "sharegpt").collect()
    with pytest.raises(Exception, match="no commit"):
        jsonl.load_instructions(spark.createDataFrame([(None, "x")], "commit string, f string"), "f", "general").collect()
    with pytest.raises(ValueError):
        jsonl.load_instructions(m, "m", "other")
    preset = jsonl.MixConfig.preset(["descriptive", "lazy"], ["f", "g"], ["m", "n"], "o")
    assert preset.ratios == [0.25] * 4 and preset.total_samples == 60_000 and jsonl.MixConfig.of(vars(preset) | {"extra": {}}).input_files == ["f", "g", "f", "g"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("é", 1)], "a string, b int")
    sinks.write_jsonl(df, f"file://{tmp_path}/o")
    sinks.write_jsonl(df, f"file://{tmp_path}/o", append=True)
    assert jsonl.read_jsonl(spark, f"file://{tmp_path}/o", "a string, b int").count() == 2
    sinks.append_statistics(df, f"file://{tmp_path}/s")
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/s").count() == 1
    assert (sinks.diff_filtered_path("d/x.jsonl"), sinks.dt_filtered_path("d/x.jsonl"), sinks.topic_sampled_path("x.jsonl", 5)) == ("d/x_diff_filtered.jsonl", "d/x_dt_filtered.jsonl", "x_topic_sampled_total_5.jsonl")


def test_streaming(spark, tmp_path):
    from spindle.streaming import stages

    two = f"[Program After Edit]\n{FENCE}\nc\nd\n{FENCE}"
    spark.createDataFrame([(response(), two), ("none", two)], "response_1 string, response_2 string").write.json(f"file://{tmp_path}/in")
    stream = stages.triplets(stages.read_stream(spark, f"file://{tmp_path}/in", "response_1 string, response_2 string"))
    q = stages.to_jsonl(stages.small_edits(stream), f"file://{tmp_path}/out", f"file://{tmp_path}/check").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.read.json(f"file://{tmp_path}/out").collect()
    assert len(got) == 1 and got[0].code_before_purify == "a\nb"


def test_verb_object_pairs():
    said = {
        "Add a docstring to the function.": [("add", "docstring")],
        "Please rename the variable and remove all unused imports!": [("rename", "variable"), ("remove", "imports")],
        "The function should return a sorted list of names": [("return", "list")],
        "Refactor the main loop to use list comprehensions, then print the total number.": [("refactor", "loop"), ("use", "comprehensions"), ("print", "number")],
        "Run": [],
        "": [],
    }
    assert {t: verb_object_pairs(t) for t in said} == said


def test_orders(spark):
    df = spark.range(200).repartition(5)
    order = [r.id for r in mix.shuffled(df, 7, "id").collect()]
    assert order == [r.id for r in mix.shuffled(df.repartition(3), 7, "id").collect()] and order != sorted(order) == list(range(200))
    assert [r.id for r in balance.in_input_order(df, "id").collect()] == list(range(200))


def test_large_groups_are_cut_where_they_lie(spark):
    df = spark.range(20_000).withColumn("g", F.when(F.col("id") < 19_000, "big").otherwise("small"))
    got = balance.balance_by_group(df, "g", "id", per_group=40, seed=3).groupBy("g").count().collect()
    assert {r.g: r["count"] for r in got} == {"big": 40, "small": 40}
    want = [r.id for r in df.filter("g = 'big'").orderBy(seeded(3, "id"), "id").limit(40).collect()]
    assert sorted(want) == sorted(r.id for r in balance.balance_by_group(df, "g", "id", per_group=40, seed=3).filter("g = 'big'").collect())


def test_clashing_names_are_replaced(spark):
    df = spark.createDataFrame([("a\nb", "a", 9, 9, "mine")], "old_code string, new_code string, added int, changed int, reason string")
    r = stats.with_diff(df).first()
    assert (r.added, r.removed, r.changed, r.reason) == (0, 1, 1, "mine")
    sections = extract.separate_sections(spark.createDataFrame([("x", "y", "mine", "mine")], "response_1 string, response_2 string, reason string, code_after string"))
    assert sections.columns.count("reason") == 1 and sections.first().reason == "missing_mark"
    asked = spark.createDataFrame([(1, "s", "u", "mine", 5)], "request_id long, system string, user string, response string, sample_index int")
    assert generate.generate(asked).first().sample_index == 1


def test_http_client(spark):
    import json
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    asked = []

    class Service(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.path, self.headers.get("Authorization"), body))
            self.send_response(503 if len(asked) == 1 else 200)
            self.end_headers()
            self.wfile.write(json.dumps({"choices": [{"message": {"role": "assistant", "content": f"{len(body['messages'])} turns"}}]}).encode())

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/v1/"
    prompts = spark.createDataFrame([(1, "s", ["one", "two"])], "request_id long, system string, user array<string>")
    got = generate.generate(prompts, lambda: generate.HttpClient(url, "some-model", "secret"), retries=2, wait_s=0).first()
    server.shutdown()
    assert got.response == ["2 turns", "4 turns"] and got.error is None
    path, key, body = asked[-1]
    assert path == "/v1/chat/completions" and key == "Bearer secret" and body["model"] == "some-model" and body["temperature"] == 0.8 and len(asked) == 3


def test_term_numbers(spark):
    """Dense, in order, in any number of parts; hot terms and others get the same numbers; null terms have none."""
    rows = [(k, f"w{k * 7 % 40:02d}", k) for k in range(200)] + [(k, "the", 1) for k in range(50)] + [(1, None, 1)]
    bag = spark.createDataFrame(rows, "doc_id long, term string, n long")
    named = {r.term: r for r in stats.term_dictionary(bag.filter("term is not null")).collect()}
    assert [named[t].term_id for t in sorted(named)] == list(range(41)) and named["the"].docs == 50
    for hot in (1, 5, 8192):
        got = stats.with_term_ids(bag, stats.term_dictionary(bag.filter("term is not null")), hot=hot)
        assert got.columns == ["doc_id", "n", "term_id"]
        assert sorted(map(tuple, got.collect())) == sorted((i, n, named[t].term_id) for i, t, n in rows if t)
    assert stats.with_term_ids(bag.limit(0), stats.term_dictionary(bag.limit(0))).collect() == []


def test_many_conversations_are_open_at_once(spark):
    """64 slow ones in a task take about as long as one; answers stay with their rows, and rounds in order."""
    import time

    class Slow(generate.StubClient):
        def complete(self, messages, *a) -> str:
            time.sleep(0.5)
            return super().complete(messages)

    prompts = spark.createDataFrame([(k, "s", [f"a{k}", f"b{k}"]) for k in range(64)], "request_id long, system string, user array<string>").coalesce(1)
    rows = lambda **o: sorted((r.request_id, r.response) for r in generate.generate(prompts, **o).collect())
    want = rows()
    began = time.time()
    assert rows(model=Slow) == want
    assert time.time() - began < 20  # one after another: 64 s
    assert rows(in_flight=1) == want


def test_generation_is_saved_as_it_goes(spark, tmp_path):
    class Unlucky(generate.StubClient):
        def complete(self, messages, *a):
            if "b" in messages[-1]["content"]:
                raise OSError("down")
            return generate.StubClient.complete(self, messages)

    prompts = spark.createDataFrame([(k, "s", t) for k, t in enumerate(["a", "b", "c", " "])], "request_id long, system string, user string")
    path = f"file://{tmp_path}/out"
    some = generate.generate_saved(prompts, path, 3, model=Unlucky, retries=1)
    assert {r.request_id for r in some.collect()} == {0, 2}
    n = spark.read.json(path).count()
    assert {r.request_id for r in generate.generate_saved(prompts, path, 3).collect()} == {0, 1, 2}
    assert spark.read.json(path).count() == n + 1  # only what had failed was asked again
    with pytest.warns(UserWarning, match="nowhere"):
        assert generate.output_fields(prompts, ["user", "nowhere"]).columns == ["user"]


def test_jobs_from_file_to_file(spark, tmp_path):
    import yaml

    marks = "[Program Before Edit]\n" + FENCE + "\nx = 1\ny = {0}\n" + FENCE + "\n[Descriptive]\nset value {0}\n[Lazy]\nset {0}"
    rows = [(f"c{k}", ["s"], marks.format(k), f"[Program After Edit]\n{FENCE}\nx = 1\ny = {k + 1}\n{FENCE}") for k in range(12)]
    root = f"file://{tmp_path}"
    sinks.write_jsonl(spark.createDataFrame(rows, "commit string, code_snippet array<string>, response_1 string, response_2 string"), f"{root}/responses")
    jobs.run_extraction(spark, f"{root}/responses", f"{root}/triplets.jsonl", f"{root}/bad")
    mix_config = {"input_files": [f"{root}/triplets.jsonl"] * 2, "ratios": [0.5, 0.5], "instr_types": ["descriptive", "lazy"], "model_names": ["m", None], "output_file": f"{root}/mixed.jsonl", "total_samples": 20, "random_seed": 42}
    (tmp_path / "mix.yaml").write_text(yaml.safe_dump(mix_config))
    mixed = jobs.run_mix(spark, f"{root}/mix.yaml")
    assert jsonl.read_jsonl(spark, mixed, schemas.MIXED).groupBy("instr_type").count().count() == 2
    filter_config = {"jsonl_path": mixed, "field_name": ["code_before_purify", "instruct_purify"], "data_format": "general", "random_seed": 42, "filter_settings": {"max_modify_lines": 70, "max_hunk_num": 7, "max_samples_total": 8}}
    (tmp_path / "filter.yaml").write_text(yaml.safe_dump(filter_config))
    kept = jobs.run_filter(spark, f"{root}/filter.yaml", k=3, iterations=2)
    assert kept == f"{root}/mixed_dt_filtered.jsonl" or kept.endswith("mixed_dt_filtered.jsonl")
    assert jsonl.read_jsonl(spark, kept, schemas.MIXED).count() == 8
    out = jobs.run_format(spark, mixed, f"{root}/records")
    assert jsonl.read_jsonl(spark, out, schemas.SHAREGPT).count() == 20
    (tmp_path / "blank.jsonl").write_text('{"commit": "a"}\n\n')
    assert jsonl.read_jsonl(spark, f"{root}/blank.jsonl", "commit string").count() == 1
    with pytest.raises(Exception, match="blank"):
        jsonl.read_jsonl(spark, f"{root}/blank.jsonl", "commit string", strict=True).collect()


def test_topic_report(spark):
    words = [["apple", "pear", "plum"], ["bolt", "screw", "nail"]]
    df = spark.createDataFrame([(k, words[k % 2] * 5) for k in range(40)] + [(99, [])], "row_id long, tokens array<string>")
    largest, described = pipelines.topic_report(df, "row_id", k=2, iterations=20)
    sizes = {r.topic: r["size"] for r in largest.collect()}
    assert sizes[-1] == 1 and sum(sizes.values()) == 41
    said = {r.topic: set(r.terms[:3]) for r in described.collect()}
    assert {frozenset(x) for t, x in said.items() if t in sizes} <= {frozenset(w) for w in words}
    topics = TopicModel.fit(df, k=2).assign(df)
    assert stats.n_groups(topics, "topic").first().n_groups == topics.filter("topic >= 0").select("topic").distinct().count()


def test_registered_queries_without_sql(spark):
    """On the smallest tables, against what the operators must hold there."""
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    tokens = {r.doc_id: r.tokens for r in queries.QUERIES["topic_documents"](spark, sf).collect()}
    assert tokens.keys() == docs.keys()
    names = [t for t in code_token_list(docs[5].text.strip()) if t.isidentifier() and t not in CODE_STOP_WORDS]
    assert [t for t in tokens[5] if t.isascii()][: len([n for n in names if n.isascii()])] == [n for n in names if n.isascii()]
    topics = {r.doc_id: r.topic for r in queries.QUERIES["topic_assign_lda"](spark, sf).collect()}
    assert topics.keys() == docs.keys() and all((topics[i] == -1) == (not any(c.isalnum() for c in docs[i].text)) for i in docs)
    kept = [r.doc_id for r in queries.QUERIES["dt_filter_topics"](spark, sf).collect()]
    assert len(kept) == len(set(kept)) <= 200 and set(kept) <= docs.keys()
    from collections import Counter

    pairs = Counter(p for d in docs.values() for p in verb_object_pairs(d.text))
    assert all(pairs[r.verb, r.object] == r["count"] for r in queries.QUERIES["verb_object_extract"](spark, sf).collect())
