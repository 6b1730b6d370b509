"""Registered queries of the engine's own operators, each with the SQL that gives the same rows."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .functions.code_tokens import CODE_STOP_WORDS, code_tokens, split_edit_prompt, topic_tokens
from .functions.diff import unified_diff
from .functions.text import seeded, split_identifier, splitlines, word_tokens
from .operators import balance, extract, finetune, generate, mix, seeds, stats
from .operators.edits import line_edits
from .operators.hdp import HdpModel, in_blocks
from .operators.topics import TopicModel
from .plans import pipelines
from .sources import jsonl, sinks
from .sources.sinks import split_rejected
from .sources.store import fresh_path, stored
from .sources.templates import get_prompts

SEED = 42


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


# ---- Inputs of the operators, made from the tables by the same projections in Spark and SQL ----


def edits(spark: SparkSession, d: str) -> DataFrame:
    """Old and new text of each document: its distinct lines, and those of them whose hash doesn't begin with 0."""
    return line_edits(_docs(spark, d).select("doc_id", "lang", "text"), "doc_id", "text").drop("text")


def responses(spark: SparkSession, d: str) -> DataFrame:
    """Two model responses round each document; one of seven lacks a mark."""
    lazy = F.when(F.col("doc_id") % 7 == 0, "Lazy").otherwise("[Lazy]")
    one = F.concat(F.lit("### [Program Before Edit]\n```python\n"), "text", F.lit("\n```\n### [Descriptive]\n**"), "source", F.lit(" edit**\n### "), lazy, F.lit("\n"), "lang", F.lit("\n---"))
    one = F.when(F.col("doc_id") % 14 == 0, F.replace(one, F.lit("### Lazy"), F.lit("Short"))).otherwise(one)
    two = F.concat(F.lit("[Program After Edit]\n```\n"), "text", F.lit("\n```"))
    return _docs(spark, d).select("doc_id", F.col("doc_id").cast("string").alias("commit"), F.array("source").alias("code_snippet"), one.alias("response_1"), two.alias("response_2"))


def commits(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", F.col("doc_id").cast("string").alias("commit"), F.col("text").alias("old_contents"), F.col("text").alias("new_contents"), F.col("source").alias("message"))


def oneshots(spark: SparkSession, d: str) -> DataFrame:
    b = spark.read.parquet(f"{d}/benchmark.parquet")
    return b.select("item_id", F.lpad(F.col("item_id").cast("string"), 8, "0").alias("code_before"), F.col("text").alias("instruct_descriptive"), F.lit("go").alias("instruct_lazy"))


#: White space of Python's str.strip(), for the SQL engine's regular expressions.
_WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


_LINES = r"""
split AS (SELECT doc_id, lang, source, string_split_regex(text, '\r\n|[\n\r\x0B\f\x1c-\x1e]|\x{85}|\x{2028}|\x{2029}') AS a FROM documents),
cut AS (SELECT doc_id, lang, source, CASE WHEN a[len(a)] = '' THEN a[1:len(a) - 1] ELSE a END AS a FROM split),
lines AS (SELECT doc_id, lang, source, unnest(a) AS line, unnest(range(1, len(a) + 1)) AS i FROM cut WHERE len(a) > 0)"""

_EDITS = (
    "WITH "
    + _LINES
    + """,
once AS (SELECT doc_id, lang, line, min(i) AS i FROM lines GROUP BY ALL),
old AS (SELECT doc_id, lang, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM once),
gone AS (SELECT doc_id, k, k - lag(k) OVER (PARTITION BY doc_id ORDER BY k) - 1 AS gap FROM old WHERE substr(md5(doc_id || ':' || k), 1, 1) = '0'),
sizes AS (SELECT d.doc_id, d.lang, count(o.k) AS n FROM documents d LEFT JOIN old o USING (doc_id) GROUP BY ALL),
cuts AS (SELECT doc_id, count(*) AS removed, 1 + count(*) FILTER (gap > 6) AS hunks FROM gone GROUP BY doc_id),
diff AS (SELECT s.doc_id, s.lang, 0 AS added, coalesce(removed, 0)::INT AS removed, 0 AS modified,
  (CASE WHEN removed IS NOT NULL THEN hunks WHEN n BETWEEN 1 AND 6 THEN 1 ELSE 0 END)::INT AS hunk_num,
  coalesce(hunks, 0)::INT AS diff_hunk_num FROM sizes s LEFT JOIN cuts USING (doc_id))
"""
)

#: Unified diffs of texts that lost lines and nothing else; also their old and new texts.
_DIFF_TEXT = (
    _EDITS.rstrip().removesuffix("SELECT")
    + """, g AS (SELECT doc_id, k, sum(CASE WHEN gap IS NULL OR gap > 6 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS h FROM gone),
hr AS (SELECT doc_id, h, greatest(min(k) - 3, 1) AS a, least(max(k) + 3, any_value(n)) AS b, count(*) AS d FROM g JOIN sizes USING (doc_id) GROUP BY doc_id, h),
ho AS (SELECT *, b - a + 1 AS old_n, b - a + 1 - d AS new_n, a - coalesce(sum(d) OVER (PARTITION BY doc_id ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS new_a FROM hr),
body AS (SELECT doc_id, h, string_agg(CASE WHEN e.k IS NULL THEN ' ' ELSE '-' END || line, chr(10) ORDER BY o.k) AS body
  FROM ho JOIN old o USING (doc_id) LEFT JOIN gone e USING (doc_id, k) WHERE o.k BETWEEN a AND b GROUP BY doc_id, h),
span AS (SELECT doc_id, h, CASE old_n WHEN 1 THEN a::VARCHAR ELSE a || ',' || old_n END AS o,
  CASE new_n WHEN 1 THEN new_a::BIGINT::VARCHAR WHEN 0 THEN (new_a - 1)::BIGINT || ',0' ELSE new_a::BIGINT || ',' || new_n END AS w FROM ho),
hunks AS (SELECT doc_id, '--- ' || chr(10) || '+++ ' || chr(10) || string_agg('@@ -' || o || ' +' || w || ' @@' || chr(10) || body, chr(10) ORDER BY h) AS diff FROM span JOIN body USING (doc_id, h) GROUP BY doc_id),
texts AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY k) AS before, coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (e.k IS NULL), '') AS after FROM old LEFT JOIN gone e USING (doc_id, k) GROUP BY doc_id),
said AS (SELECT doc_id, coalesce(h.diff, '') AS diff FROM sizes LEFT JOIN hunks h USING (doc_id))"""
)


def _rewrite_sql() -> str:
    """The rewriting prompt of each commit: the template's pieces between quotes, and what fills them."""
    values = {"old_code": "before", "diff": "diff", "commit_message": "lang", "desc_instr_shot": "shot", "lazy_instr_shot": "'go'"}
    system, (template,) = get_prompts("v5.9")
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    pieces = [values[x] if k % 2 else quoted(x) for k, x in enumerate(re.split(r"\{(\w+)\}", template)) if k % 2 or x]
    return _DIFF_TEXT + f""", shots AS (SELECT text AS shot, row_number() OVER (ORDER BY lpad(item_id::VARCHAR, 8, '0')) - 1 AS s, count(*) OVER () AS n FROM benchmark)
SELECT doc_id::VARCHAR AS commit, {quoted(system)} AS system, {" || ".join(pieces)} AS user, before AS old_code, after AS new_code, lang AS commit_message
FROM documents JOIN said USING (doc_id) JOIN texts USING (doc_id) JOIN shots ON s = ('0x' || substr(md5('42:shot:' || doc_id), 1, 8))::BIGINT % shots.n
WHERE before <> '' AND after <> '' AND lang <> ''"""


_RESP = """WITH resp AS (SELECT doc_id, doc_id::VARCHAR AS commit, source, lang, text,
  CASE WHEN doc_id % 14 = 0 THEN replace(one, '### Lazy', 'Short') ELSE one END AS r1,
  '[Program After Edit]' || chr(10) || '```' || chr(10) || text || chr(10) || '```' AS r2 FROM (
    SELECT *, '### [Program Before Edit]' || chr(10) || '```python' || chr(10) || text || chr(10) || '```' || chr(10) || '### [Descriptive]' || chr(10) || '**' || source
      || ' edit**' || chr(10) || '### ' || CASE WHEN doc_id % 7 = 0 THEN 'Lazy' ELSE '[Lazy]' END || chr(10) || lang || chr(10) || '---' AS one FROM documents))"""


def _marks(fn: str, marks: tuple[str, ...], text: str, plus: bool) -> str:
    return f"{fn}(" + ", ".join(f"nullif(instr({text}, '{m}'), 0)" + (f" + {len(m)}" if plus else "") for m in marks) + ")"


def _sections_sql() -> str:
    start = lambda marks, t: _marks("greatest", marks, t, True)
    end = lambda marks: _marks("least", marks, "r1", False)
    has = lambda marks, t: "(" + " OR ".join(f"contains({t}, '{m}')" for m in marks) + ")"
    ends = ", ".join(f"nullif(instr(substr(r1, lf), '{m}'), 0)" for m in extract.LAZY_ENDS)
    cut = lambda a, b: _strip(f"substr(r1, {a}, greatest({b} - {a}, 0))")
    return (
        _RESP
        + f""", sec AS (SELECT *, {cut(start(extract.OLD_CODE_MARKS, 'r1'), end(extract.DESCRIPTIVE_MARKS))} AS code_before,
  {cut(start(extract.DESCRIPTIVE_MARKS, 'r1'), end(extract.LAZY_MARKS))} AS instruct_descriptive,
  {_strip(f"substr(r1, lf, coalesce(least({ends}), length(r1)) - 1)")} AS instruct_lazy,
  {_strip(f"substr(r2, {start(extract.NEW_CODE_MARKS, 'r2')})")} AS code_after,
  {has(extract.OLD_CODE_MARKS, 'r1')} AND {has(extract.DESCRIPTIVE_MARKS, 'r1')} AND {has(extract.LAZY_MARKS, 'r1')} AND {has(extract.NEW_CODE_MARKS, 'r2')} AS marked
  FROM (SELECT *, {start(extract.LAZY_MARKS, 'r1')} AS lf FROM resp)),
good AS (SELECT * FROM sec WHERE marked AND code_after <> '' AND instruct_descriptive <> '' AND instruct_lazy <> '')"""
    )


def _purified(c: str) -> str:
    """The fences of these responses have no inner fence, so there is one block."""
    code = _strip(f"coalesce(regexp_extract({c}, '```([^\\s`]+)?\\s*\\n([\\s\\S]*?)```', 2), '')")
    return f"(CASE WHEN {code} = '' THEN NULL WHEN starts_with({code}, 'python') THEN CASE WHEN contains({code}, chr(10)) THEN substr({code}, instr({code}, chr(10)) + 1) ELSE '' END ELSE {code} END)"


_TRIPLETS = (
    _sections_sql()
    + f""", t AS (SELECT doc_id, commit, code_before, code_after, instruct_descriptive, instruct_lazy,
  {_purified('code_before')} AS code_before_purify, {_purified('code_after')} AS code_after_purify,
  trim(instruct_descriptive, '-`*# ' || chr(10)) AS instruct_descriptive_purify, trim(instruct_lazy, '-`*# ' || chr(10)) AS instruct_lazy_purify
  FROM good WHERE NOT (NOT contains(code_before, chr(10)) OR contains(code_before, '─') OR starts_with({_strip('code_before')}, '$')
    OR NOT contains(code_after, chr(10)) OR contains(code_after, '─') OR starts_with({_strip('code_after')}, '$')))"""
)

_NAMES = ["commit", "code_before_purify", "code_after_purify", "instruct_descriptive_purify", "instruct_lazy_purify"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- Loading ----


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, text) AS instruction FROM conversations WHERE role = 'user' GROUP BY conv_id")
def load_sharegpt_user(spark, d):
    return jsonl.user_turns(spark.read.parquet(f"{d}/conversations.parquet"))


@query("SELECT string_agg(text, chr(10) ORDER BY turn, text) AS instruction, conv_id::VARCHAR AS commit FROM conversations WHERE role = 'user' GROUP BY conv_id")
def load_sharegpt_messages(spark, d):
    t = spark.read.parquet(f"{d}/conversations.parquet").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text", "role"))).alias("t"))
    messages = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
    t = t.filter(F.exists("t", lambda x: x["role"] == "user")).select(messages.alias("messages"), F.col("conv_id").cast("string").alias("commit"))
    return jsonl.load_instructions(t, "messages", "sharegpt")


@query("SELECT '## Code Before:' || chr(10) || text || chr(10) || '## Instruction:' || chr(10) || source || chr(10) || '## Code After:' || chr(10) AS instruction, doc_id::VARCHAR AS commit FROM documents")
def load_general_two_field(spark, d):
    return jsonl.load_instructions(_docs(spark, d).withColumn("commit", F.col("doc_id").cast("string")), ["text", "source"], "general")


@query("SELECT source AS instruction, doc_id::VARCHAR AS commit FROM documents")
def load_general_one_field(spark, d):
    return jsonl.load_instructions(_docs(spark, d).withColumn("commit", F.col("doc_id").cast("string")), "source", "general")


@query("SELECT doc_id, doc_id || ',' || lang AS commit FROM documents")
def commit_normalise(spark, d):
    return _docs(spark, d).select("doc_id", jsonl.joined_commit(F.array(F.col("doc_id").cast("string"), "lang")).alias("commit"))


# ---- Seeds and prompts ----


@query("WITH " + _LINES + " SELECT doc_id, count(*) AS n_lines FROM lines GROUP BY doc_id HAVING count(*) >= 5")
def snippet_line_filter(spark, d):
    return seeds.long_enough(_docs(spark, d), "text").select("doc_id", F.size(splitlines("text")).cast("long").alias("n_lines"))


_SNIPPET = """picked AS (SELECT doc_id, a, len(a) AS n, md5('42:' || doc_id) AS h FROM cut WHERE len(a) >= 5),
sized AS (SELECT *, 5 + ('0x' || substr(h, 1, 8))::BIGINT % (least(15, n) - 4) AS size FROM picked),
placed AS (SELECT *, ('0x' || substr(h, 9, 8))::BIGINT % (n - size + 1) AS start FROM sized)"""


@query("WITH " + _LINES + ", " + _SNIPPET + " SELECT doc_id, array_to_string(a[start + 1:start + size], chr(10)) AS snippet FROM placed")
def sample_snippet(spark, d):
    x = seeds.long_enough(_docs(spark, d), "text")
    return x.select("doc_id", seeds.snippet(splitlines("text"), seeded(SEED, "doc_id")).alias("snippet"))


N_PAIRS = 2000
_VALID = "valid AS (SELECT doc_id, text, source, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id::VARCHAR) - 1 AS idx FROM documents WHERE text <> '')"
_PAIRS = f"""drawn AS (SELECT i, md5('42:pair:' || i) AS h, (SELECT count(*) FROM valid) AS n FROM range({N_PAIRS}) t(i)),
lefts AS (SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % n AS l FROM drawn),
pairs AS (SELECT i, l, (l + 1 + ('0x' || substr(h, 9, 8))::BIGINT % (n - 1)) % n AS r FROM lefts)"""


@query(f"WITH {_VALID}, {_PAIRS} SELECT i, a.doc_id::VARCHAR AS left_commit, b.doc_id::VARCHAR AS right_commit FROM pairs JOIN valid a ON a.idx = l JOIN valid b ON b.idx = r")
def seed_pairs(spark, d):
    good = seeds.indexed(seeds.valid_commits(commits(spark, d)), "commit", SEED)
    drawn = seeds.pairs(spark, N_PAIRS, good.count(), SEED)
    side = lambda s: good.select(F.col("idx").alias(f"{s}_idx"), F.col("commit").alias(f"{s}_commit"))
    return drawn.join(side("left"), "left_idx").join(side("right"), "right_idx").select("i", "left_commit", "right_commit")


_SHOTS = "shots AS (SELECT item_id, text AS shot, row_number() OVER (ORDER BY lpad(item_id::VARCHAR, 8, '0')) - 1 AS s, count(*) OVER () AS n FROM benchmark)"


@query(f"WITH {_SHOTS} SELECT doc_id, item_id FROM documents JOIN shots ON s = ('0x' || substr(md5('42:shot:' || doc_id), 1, 8))::BIGINT % n")
def oneshot_assign(spark, d):
    return seeds.assign_oneshot(_docs(spark, d).select("doc_id"), oneshots(spark, d), "doc_id", "code_before", SEED).select("doc_id", "item_id")


@query(
    "WITH "
    + _LINES
    + """, ok AS (SELECT doc_id, source, a, len(a) AS m, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id::VARCHAR) - 1 AS idx FROM cut WHERE len(a) >= 5),
"""
    + _PAIRS.replace("FROM valid", "FROM ok").replace(str(N_PAIRS), "500")
    + """, both_sides AS (SELECT i, 'left' AS side, l AS idx FROM pairs UNION ALL SELECT i, 'right', r FROM pairs),
hashed AS (SELECT i, side, ok.*, md5('42:' || side || ':' || i) AS h FROM both_sides JOIN ok USING (idx)),
sized AS (SELECT *, 5 + ('0x' || substr(h, 1, 8))::BIGINT % (least(15, m) - 4) AS size FROM hashed),
placed AS (SELECT *, ('0x' || substr(h, 9, 8))::BIGINT % (m - size + 1) AS start FROM sized),
snips AS (SELECT i, side, doc_id, source, array_to_string(a[start + 1:start + size], chr(10)) AS snippet FROM placed),
"""
    + _SHOTS
    + """ SELECT x.i, x.doc_id || ',' || y.doc_id AS commit, x.source || ',' || y.source AS message, x.snippet AS snippet_1, y.snippet AS snippet_2,
  true AS user_has_snippets, shot AS example
FROM snips x JOIN snips y ON x.i = y.i AND x.side = 'left' AND y.side = 'right' JOIN shots ON s = ('0x' || substr(md5('42:shot:' || x.i), 1, 8))::BIGINT % n"""
)
def fill_prompt(spark, d):
    p = seeds.create_prompts(commits(spark, d), oneshots(spark, d), 500, SEED)
    user = F.get("user", F.lit(0))
    example = F.split(F.split(user, r"\[Descriptive\]\n", 2)[1], r"\n\n\[Lazy\]", 2)[0]
    has = user.contains(F.get("code_snippet", F.lit(0))) & user.contains(F.get("code_snippet", F.lit(1))) & (F.size("user") == 2)
    return p.select("i", F.array_join("commit", ",").alias("commit"), F.array_join("commit_message", ",").alias("message"), F.col("code_snippet")[0].alias("snippet_1"), F.col("code_snippet")[1].alias("snippet_2"), has.alias("user_has_snippets"), example.alias("example"))


def _blanked(spark, d):
    blank = lambda k, c: F.when(F.col("doc_id") % 5 == k, "").otherwise(F.col(c)).alias(c)
    return commits(spark, d).select("commit", blank(1, "old_contents"), blank(2, "new_contents"), blank(3, "message"))


@query("SELECT CASE doc_id % 5 WHEN 1 THEN 'old_contents' WHEN 2 THEN 'new_contents' WHEN 3 THEN 'message' END AS reason, count(*) AS n FROM documents GROUP BY 1")
def reject_reasons(spark, d):
    return _blanked(spark, d).groupBy(seeds.reject_reason().alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(_rewrite_sql())
def rewrite_prompts(spark, d):
    e = edits(spark, d)
    c = e.select(F.col("doc_id").cast("string").alias("commit"), F.col("code_before_purify").alias("old_contents"), F.col("code_after_purify").alias("new_contents"), F.col("lang").alias("message"))
    return seeds.rewrite_prompts(c, oneshots(spark, d), SEED)


# ---- Extraction ----


@query(_sections_sql() + " SELECT doc_id, code_before, instruct_descriptive, instruct_lazy, code_after FROM good")
def separate_sections(spark, d):
    good, _ = split_rejected(extract.separate_sections(responses(spark, d)))
    return good.select("doc_id", "code_before", "instruct_descriptive", "instruct_lazy", "code_after")


@query(_sections_sql() + " SELECT CASE WHEN marked THEN 'empty_section' ELSE 'missing_mark' END AS reason, count(*) AS n FROM sec WHERE doc_id NOT IN (SELECT doc_id FROM good) GROUP BY 1")
def quarantine_counts(spark, d):
    _, bad = split_rejected(extract.separate_sections(responses(spark, d)))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT doc_id FROM documents WHERE contains(text, chr(10)) AND NOT contains(text, '─') AND NOT starts_with({_strip('text')}, '$')")
def filter_single_line(spark, d):
    return extract.filter_single_line(_docs(spark, d), ("text",)).select("doc_id")


@query(_RESP + f" SELECT doc_id, {_purified('r1')} AS before, {_purified('r2')} AS after FROM resp")
def purify_code(spark, d):
    return responses(spark, d).select("doc_id", extract.purified_code(F.col("response_1")).alias("before"), extract.purified_code(F.col("response_2")).alias("after"))


@query("SELECT doc_id, trim('## **' || source || '** ' || chr(10) || text || chr(10) || '---', '-`*# ' || chr(10)) AS instruction FROM documents")
def purify_instruction(spark, d):
    c = F.concat(F.lit("## **"), "source", F.lit("** \n"), "text", F.lit("\n---"))
    return _docs(spark, d).select("doc_id", extract.purified_instruction(c).alias("instruction"))


@query(_TRIPLETS + f" SELECT {', '.join(_NAMES)} FROM t")
def extract_triplets(spark, d):
    good, _ = pipelines.extract_triplets(responses(spark, d))
    return good.select(*_NAMES)


# ---- Mixing ----


@query("""WITH g AS (SELECT lang, count(*) AS size FROM documents GROUP BY lang), e AS (SELECT *, size * 1000.0 / sum(size) OVER () AS x FROM g),
f AS (SELECT *, floor(x) AS whole, x - floor(x) AS frac FROM e)
SELECT lang, (whole + CASE WHEN row_number() OVER (ORDER BY frac DESC, lang) <= 1000 - sum(whole) OVER () THEN 1 ELSE 0 END)::BIGINT AS target FROM f""")
def largest_remainder(spark, d):
    every = Window.partitionBy()  # of one row per language
    x = _docs(spark, d).groupBy("lang").count().withColumn("x", F.col("count") * 1000.0 / F.sum("count").over(every)).withColumn("whole", F.floor("x"))
    spare = F.row_number().over(Window.orderBy(F.desc(F.col("x") - F.col("whole")), F.asc_nulls_last("lang"))) <= 1000 - F.sum("whole").over(every)
    return x.select("lang", (F.col("whole") + F.when(spare, 1).otherwise(0)).cast("long").alias("target"))


@query("SELECT 'first' AS name, doc_id FROM (SELECT doc_id FROM documents ORDER BY md5('42:first:' || doc_id), doc_id LIMIT 120) UNION ALL SELECT 'second', doc_id FROM (SELECT doc_id FROM documents ORDER BY md5('42:second:' || doc_id), doc_id LIMIT 80)")
def sample_per_source(spark, d):
    x = _docs(spark, d).select("doc_id")
    part = lambda name, n: mix.sample_rows(x, n, "doc_id", SEED, name, clamp=True).select(F.lit(name).alias("name"), "doc_id")
    return part("first", 120).unionByName(part("second", 80))


_MIXED = _TRIPLETS + """, s1 AS (SELECT * FROM t ORDER BY md5('42:a:' || doc_id), doc_id LIMIT 100), s2 AS (SELECT * FROM t ORDER BY md5('42:b:' || doc_id), doc_id LIMIT 50),
mixed AS (SELECT commit, coalesce(code_before_purify, '') AS code_before_purify, coalesce(code_after_purify, '') AS code_after_purify, instruct_descriptive_purify AS instruct_purify, 'alpha_descriptive' AS instr_type FROM s1
  UNION ALL SELECT commit, coalesce(code_before_purify, ''), coalesce(code_after_purify, ''), instruct_lazy_purify, 'unknown_lazy' FROM s2)"""


def _mixed(spark, d):
    good, _ = pipelines.extract_triplets(responses(spark, d))
    return mix.sample_and_mix([good, good], ["descriptive", "lazy"], ["alpha", None], [2 / 3, 1 / 3], 150, SEED, "doc_id", ["a", "b"])


@query(_MIXED + " SELECT * FROM mixed WHERE instruct_purify <> ''")
def mix_styles(spark, d):
    return _mixed(spark, d).drop("code_snippet")


_PROMPT = """'## Code Before:' || chr(10) || CASE WHEN ('0x' || substr(md5('42:' || commit || ':' || instr_type), 1, 1))::BIGINT % 2 = 1
  THEN '```python' || chr(10) || code_before_purify || chr(10) || '```' ELSE code_before_purify END
  || chr(10) || '## Instruction:' || chr(10) || instruct_purify || chr(10) || '## Code After:' || chr(10)"""
_ANSWER = "'```python' || chr(10) || code_after_purify || chr(10) || '```'"
_RECORD = f"SELECT {_PROMPT} AS instruction, 'You edit code as you are told.' AS system, {_ANSWER} AS output, commit, instr_type, code_before_purify AS old_code, code_after_purify AS new_code FROM mixed WHERE instruct_purify <> ''"


_ALL = _TRIPLETS + """, mixed AS (SELECT commit, coalesce(code_before_purify, '') AS code_before_purify, coalesce(code_after_purify, '') AS code_after_purify,
  instruct_{0}_purify AS instruct_purify, 'alpha_{0}' AS instr_type FROM t) """


def _styled(spark, d, style: str) -> DataFrame:
    """All triplets as records of one style."""
    good, _ = pipelines.extract_triplets(responses(spark, d))
    return mix.as_style(good, style, "alpha")


@query(_ALL.replace("{0}", "descriptive") + _RECORD)
def format_alpaca(spark, d):
    return finetune.format_records(_styled(spark, d, "descriptive"), "alpaca", SEED)


@query(_ALL.replace("{0}", "lazy") + "SELECT system, instruction AS user, output AS assistant, commit, instr_type, 3 AS turns FROM (" + _RECORD + ")")
def format_sharegpt(spark, d):
    r = finetune.format_records(_styled(spark, d, "lazy"), "share_gpt", SEED)
    said = lambda k: F.get("messages", F.lit(k))
    return r.select(*[said(k)["content"].alias(n) for k, n in enumerate(("system", "user", "assistant"))], "commit", "instr_type", F.size("messages").alias("turns"))


# ---- Diffs ----


@query(_EDITS + "SELECT doc_id, added, removed, modified, hunk_num, diff_hunk_num FROM diff")
def diff_stats(spark, d):
    return stats.with_diff(edits(spark, d), "code_before_purify", "code_after_purify").select("doc_id", "added", "removed", "modified", "hunk_num", "diff_hunk_num")


@query(_EDITS + "SELECT doc_id FROM diff WHERE removed BETWEEN 1 AND 3 AND hunk_num <= 1")
def diff_filter(spark, d):
    return stats.filter_by_diff(edits(spark, d), max_modify_lines=3, max_hunk_num=1).select("doc_id")


def _summary_sql(metric: str, value: str, limit: int) -> str:
    return f"SELECT '{metric}' AS metric, min({value})::BIGINT AS least, max({value})::BIGINT AS most, median({value}) AS median, count(*) FILTER ({value} > {limit}) AS above, coalesce(count(*) FILTER ({value} > {limit})::DOUBLE / nullif(count(*), 0), 0.0) AS ratio FROM diff"


@query(_EDITS + _summary_sql("changed", "removed", 2) + " UNION ALL " + _summary_sql("hunk_num", "hunk_num", 1))
def diff_summary(spark, d):
    return stats.diff_summary(stats.with_diff(edits(spark, d), "code_before_purify", "code_after_purify"), 2, 1)


@query(_EDITS + """, m AS (SELECT greatest(ceil(max(removed) / 5.0), 1)::BIGINT AS bins FROM diff), c AS (SELECT least(removed // 5, bins - 1) AS b, count(*) AS n FROM diff, m GROUP BY 1)
SELECT b * 5 AS bin_start, coalesce(n, 0)::BIGINT AS n FROM (SELECT unnest(range(bins)) AS b FROM m) LEFT JOIN c USING (b)""")
def diff_histogram(spark, d):
    return stats.histogram(stats.with_diff(edits(spark, d), "code_before_purify", "code_after_purify"), "changed", 5)


@query(_DIFF_TEXT + " SELECT doc_id, diff FROM said")
def unified_diff_text(spark, d):
    return edits(spark, d).select("doc_id", unified_diff("code_before_purify", "code_after_purify").alias("diff"))


@query(_EDITS + "SELECT removed::INT AS x, hunk_num AS y, count(*) AS n FROM diff GROUP BY ALL")
def diff_scatter(spark, d):
    return stats.scatter(stats.with_diff(edits(spark, d), "code_before_purify", "code_after_purify"), "changed", "hunk_num")


# ---- Tokens and topics ----


@query(f"SELECT doc_id, {_strip('text')} AS code, source AS instruction FROM documents")
def split_edit_prompts(spark, d):
    x = _docs(spark, d)
    code, instruction = split_edit_prompt(jsonl.edit_prompt_text(F.col("text"), F.col("source")))
    return x.select("doc_id", code.alias("code"), instruction.alias("instruction"))


_WORDS = r"""words AS (SELECT doc_id, lower(regexp_replace(w, '[^\p{L}\p{N}_]', '', 'g')) AS term FROM (SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS w FROM documents))"""


@query("WITH " + _WORDS + " SELECT doc_id, count(*) AS n, md5(string_agg(term, ' ' ORDER BY term)) AS words FROM words WHERE term <> '' GROUP BY doc_id")
def word_token_digests(spark, d):
    x = _docs(spark, d).select("doc_id", word_tokens("text").alias("t")).filter(F.size("t") > 0)
    return x.select("doc_id", F.size("t").cast("long").alias("n"), F.md5(F.array_join(F.array_sort("t"), " ")).alias("words"))


def _bags(spark, d) -> DataFrame:
    """Texts are dealt by id, as they are shorter than the rows of their bags, which then are counted where they are made."""
    return stats.bag_of_words(_docs(spark, d).select("doc_id", "text").repartition("doc_id").select("doc_id", word_tokens("text").alias("t")), "doc_id", "t")


@query("SELECT doc_id, term, count(*) AS n FROM (WITH " + _WORDS + " SELECT * FROM words WHERE term <> '') GROUP BY ALL")
def bag_of_words(spark, d):
    return _bags(spark, d)


@query("WITH " + _WORDS + ", b AS (SELECT doc_id, term, count(*) AS n FROM words WHERE term <> '' GROUP BY ALL) SELECT doc_id, dense_rank() OVER (ORDER BY term) - 1 AS term_id, n FROM b")
def bag_of_word_ids(spark, d):
    """The bags by number: every term of the corpus has one, in the order of its bytes."""
    bag = stored(_bags(spark, d), "bag")
    return stats.with_term_ids(bag, stats.term_dictionary(bag))


@query(r"""SELECT p_partkey, array_to_string(list_filter(string_split_regex(regexp_replace(replace(p_name, ' ', '_') || 'HTTPServer_' || p_brand, '([a-z])([A-Z])', '\1 \2', 'g'), '[\s_]+'), lambda x: x <> ''), '|') AS parts FROM part""")
def split_identifiers(spark, d):
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("HTTPServer_"), "p_brand")
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.array_join(split_identifier(name), "|").alias("parts"))


#: Names of parts as code, "sky_blue = brand_12", and their types as its instruction.
_CODE = "lower(replace(p_name, ' ', '_')) || ' = ' || lower(replace(p_brand, '#', '_'))"
_CODE_PARTS = "list_concat(list_concat(string_split(lower(p_name), ' '), ['=']), string_split(lower(replace(p_brand, '#', '_')), '_'))"


def _part_code(spark, d) -> DataFrame:
    under = lambda c, old: F.lower(F.replace(c, F.lit(old), F.lit("_")))
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_type", F.concat(under("p_name", " "), F.lit(" = "), under("p_brand", "#")).alias("code"))


@query(f"SELECT p_partkey, array_to_string(list_filter({_CODE_PARTS}, lambda x: x <> ''), '|') AS tokens FROM part")
def code_token_lists(spark, d):
    return _part_code(spark, d).select("p_partkey", F.array_join(code_tokens("code"), "|").alias("tokens"))


@query(rf"""SELECT p_partkey, array_to_string(list_concat(list_filter({_CODE_PARTS}, lambda x: regexp_full_match(x, '[\p{{L}}_][\p{{L}}\p{{N}}_]*') AND x NOT IN ({", ".join(f"'{x}'" for x in CODE_STOP_WORDS)})),
  list_filter(string_split(lower('make it ' || p_type), ' '), lambda x: regexp_full_match(x, '\p{{L}}+') AND x NOT IN ('it'))), '|') AS tokens FROM part""")
def topic_token_lists(spark, d):
    text = jsonl.edit_prompt_text(F.col("code"), F.concat(F.lit("Make it "), "p_type"))
    return _part_code(spark, d).select("p_partkey", F.array_join(topic_tokens(text), "|").alias("tokens"))


@query("SELECT count(DISTINCT CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END) AS n_groups FROM documents")
def topic_number(spark, d):
    topic = F.when(F.col("doc_id") % 3 == 0, "-1").otherwise(F.col("source")).alias("topic")
    return stats.n_groups(_docs(spark, d).select(topic), "topic")


@query()
def topic_assign_lda(spark, d):
    x = _docs(spark, d).select("doc_id", "text", word_tokens("text").alias("tokens"))
    blocks = in_blocks(x, "doc_id", about=F.length("text") / 6, empty=True)
    model, bags = TopicModel.fit_blocks(blocks, seed=SEED, kind=x.schema["doc_id"].dataType.simpleString())
    return model.topics_of(bags).withColumnRenamed("id", "doc_id")


@query()
def topic_assign_hdp(spark, d):
    x = _docs(spark, d).select("doc_id", "text", word_tokens("text").alias("tokens"))
    blocks = in_blocks(x, "doc_id", about=F.length("text") / 6)  # the words are on disk in these only
    return HdpModel.fit(x, seed=SEED, blocks=blocks).assign(x, key="doc_id", blocks=blocks).select("doc_id", "topic")


@query()
def topic_documents(spark, d):
    x = _docs(spark, d)
    return x.select("doc_id", topic_tokens(jsonl.edit_prompt_text(F.col("text"), F.col("source"))).alias("tokens"))


# ---- Balanced samples ----


def _fill_sql(table: str, group: str, row: str, total: int) -> str:
    return f"""WITH sizes AS (SELECT {group}, count(*) AS size, min({row}) AS first_row FROM {table} GROUP BY {group}),
r AS (SELECT *, row_number() OVER (ORDER BY size, first_row) - 1 AS i, count(*) OVER () AS n, coalesce(sum(size) OVER (ORDER BY size, first_row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS less FROM sizes),
k AS (SELECT *, size * (n - i) <= {total} - less AS locked FROM r),
o AS (SELECT *, {total} - coalesce(sum(size) FILTER (locked) OVER (), 0) AS rest, count(*) FILTER (NOT locked) OVER () AS u,
  count(*) FILTER (NOT locked) OVER (ORDER BY first_row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM k),
q AS (SELECT {group}, size, first_row, (CASE WHEN locked THEN size ELSE rest // u + CASE WHEN p < rest % u THEN 1 ELSE 0 END END)::BIGINT AS target FROM o)"""


@query(_fill_sql("documents", "lang", "doc_id", 300) + " SELECT lang, size, first_row, target FROM q")
def water_fill_quota(spark, d):
    return balance.water_fill(balance.group_sizes(_docs(spark, d), "lang", "doc_id"), 300, "lang")


@query(_fill_sql("documents", "lang", "doc_id", 301) + ", s AS (SELECT doc_id, lang, target, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM documents JOIN q USING (lang)) SELECT doc_id, lang FROM s WHERE rn <= target")
def topic_balanced_sample(spark, d):
    return balance.balance_by_group(_docs(spark, d), "lang", "doc_id", total=301, seed=SEED).select("doc_id", "lang")


@query(_fill_sql("embeddings", "label", "vec_id", 333) + ", s AS (SELECT vec_id, label, target, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id), vec_id) AS rn FROM embeddings JOIN q USING (label)) SELECT vec_id, label FROM s WHERE rn <= target")
def label_balanced_sample(spark, d):
    return balance.balance_by_group(spark.read.parquet(f"{d}/embeddings.parquet"), "label", "vec_id", total=333, seed=SEED).select("vec_id", "label")


@query("SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY md5('42:' || event_id), event_id) AS rn FROM events) WHERE rn <= 50")
def topic_cap_sample(spark, d):
    return balance.balance_by_group(spark.read.parquet(f"{d}/events.parquet"), "event_type", "event_id", per_group=50, seed=SEED).select("event_id", "event_type")


@query("SELECT source, count(*) AS size, min(doc_id) AS first_row FROM documents GROUP BY source ORDER BY size DESC, first_row LIMIT 20")
def topic_counts_top20(spark, d):
    return stats.top_groups(_docs(spark, d), "source", "doc_id")


@query(_EDITS + ", kept AS (SELECT doc_id, lang FROM diff WHERE removed BETWEEN 1 AND 5 AND hunk_num <= 2), q AS (SELECT * FROM (" + _fill_sql("kept", "lang", "doc_id", 60) + " SELECT * FROM q)), s AS (SELECT doc_id, lang, target, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM kept JOIN q USING (lang)) SELECT doc_id, lang FROM s WHERE rn <= target")
def dt_filter(spark, d):
    config = jsonl.FilterConfig("", [], "general", SEED, 5, 2, 60)
    return pipelines.group_balanced(edits(spark, d), "lang", "doc_id", config).select("doc_id", "lang")


_TOPICS = "(SELECT doc_id, (CASE WHEN doc_id % 7 = 0 THEN -1 ELSE ('0x' || substr(md5(source), 1, 4))::INT % 5 END)::INT AS topic FROM documents)"


@query("WITH x AS " + _TOPICS + ", q AS (SELECT * FROM (" + _fill_sql("x", "topic", "doc_id", 200) + " SELECT * FROM q)), s AS (SELECT doc_id, topic, target, row_number() OVER (PARTITION BY topic ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM x JOIN q USING (topic)) SELECT doc_id, topic FROM s WHERE rn <= target")
def topic_filter_balance(spark, d):
    """The end of the topic filter, with topics that SQL can tell; documents without tokens are topic -1."""
    topic = F.when(F.col("doc_id") % 7 == 0, -1).otherwise(F.conv(F.substring(F.md5("source"), 1, 4), 16, 10).cast("int") % 5).cast("int")
    return pipelines.topic_sample(_docs(spark, d).select("doc_id", topic.alias("topic")), "topic", "doc_id", jsonl.FilterConfig("", [], "general", SEED, 5, 2, 200))


@query()
def dt_filter_topics(spark, d):
    """The whole filter: diffs, a topic model fitted on what is left, balance over its topics."""
    mixed = edits(spark, d).withColumn("instruct_purify", F.col("lang"))
    return pipelines.dt_filter(mixed, jsonl.FilterConfig("", [], "general", SEED, 70, 7, 200), "doc_id").select("doc_id")


#: Pieces of SQL that the jobs' queries share.
LINES_SQL, SNIPPET_SQL, TEXTS_SQL, fill_sql = _LINES, _SNIPPET, _DIFF_TEXT, _fill_sql


# ---- Statistics ----

_PAIRS_OF = "c AS (SELECT event_type AS verb, json_extract_string(props, '$.k') AS object, count(*) AS count FROM events GROUP BY ALL), v AS (SELECT verb FROM c GROUP BY verb ORDER BY sum(count) DESC, verb LIMIT 3), r AS (SELECT c.*, row_number() OVER (PARTITION BY verb ORDER BY count DESC, object) AS rn FROM c SEMI JOIN v USING (verb))"


def _event_pairs(spark, d) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet")
    return stats.count_pairs(e.select(F.col("event_type").alias("verb"), F.get_json_object("props", "$.k").alias("object")))


@query("WITH " + _PAIRS_OF + " SELECT verb, object, count FROM r WHERE rn <= 5")
def verb_object_topk(spark, d):
    return stats.top_pairs(_event_pairs(spark, d), 3, 5)


@query("WITH " + _PAIRS_OF + " SELECT verb, CASE WHEN rn <= 5 THEN object ELSE '<other>' END AS object, sum(count)::BIGINT AS count FROM r GROUP BY ALL")
def verb_object_other(spark, d):
    return stats.top_pairs(_event_pairs(spark, d), 3, 5, drop_other=False)


@query("WITH " + _PAIRS_OF + ", p AS (SELECT * FROM r WHERE rn <= 5) SELECT verb || '/' || object AS id, verb AS parent, object AS label, count AS value FROM p UNION ALL SELECT verb, '', verb, sum(count)::BIGINT FROM p GROUP BY verb")
def verb_object_sunburst(spark, d):
    return stats.sunburst(stats.top_pairs(_event_pairs(spark, d), 3, 5))


#: Instructions by document, with the verb and object that a reader finds in them.
_SAID = [("Please add a short docstring to the {} function.", "add", "docstring"), ("Rename the variable, then remove the unused {} import", "rename", "variable"), ("It should return a sorted list of {} names.", "return", "list")]


@query("SELECT verb, object, count(*) AS count FROM (SELECT unnest(CASE doc_id % 3 WHEN 0 THEN [('add', 'docstring')] WHEN 1 THEN [('rename', 'variable'), ('remove', 'import')] ELSE [('return', 'list')] END) AS p, p[1] AS verb, p[2] AS object FROM documents) GROUP BY ALL")
def verb_object_pairs(spark, d):
    text = F.element_at(F.array(*[F.replace(F.lit(t), F.lit("{}"), F.col("lang")) for t, _, _ in _SAID]), (F.col("doc_id") % 3 + 1).cast("int"))
    return stats.count_pairs(stats.verb_objects(_docs(spark, d).select(text.alias("text")), "text"))


@query()
def verb_object_extract(spark, d):
    return pipelines.verb_object_report(_docs(spark, d), "text")


@query("WITH p AS (SELECT source, avg(quality) AS p FROM labels JOIN documents USING (doc_id) GROUP BY source) SELECT count(*) AS problems, avg(p) AS pass_at_1 FROM p")
def pass_at_1(spark, d):
    x = spark.read.parquet(f"{d}/labels.parquet").join(_docs(spark, d).select("doc_id", "source"), "doc_id")
    return stats.pass_at_1(x, "source", "quality")


# ---- Generation ----


def _requests(spark, d) -> DataFrame:
    return _docs(spark, d).select(F.col("doc_id").alias("request_id"), F.lit("s").alias("system"), F.array("source", "lang").alias("user"))


_ROUNDS = "WITH a AS (SELECT doc_id AS request_id, k AS sample_index, source, lang, md5('system:s' || chr(10) || 'user:' || source) AS r1 FROM documents, range(1, 3) t(k))"


@query(_ROUNDS + " SELECT request_id, sample_index::INT AS sample_index, r1 AS response_1, md5('system:s' || chr(10) || 'user:' || source || chr(10) || 'assistant:' || r1 || chr(10) || 'user:' || lang) AS response_2 FROM a")
def generate_stub(spark, d):
    g = generate.generate(_requests(spark, d), num_completion=2)
    return generate.output_fields(generate.flatten_rounds(g, 2), ["request_id", "sample_index", "response_1", "response_2"])


@query("SELECT doc_id AS request_id, k::INT AS sample_index FROM documents, range(1, 3) t(k) WHERE NOT (doc_id % 3 = 0 AND k = 1)")
def generate_resume(spark, d):
    r = _requests(spark, d)
    done = r.filter("request_id % 3 = 0").select("request_id", F.lit(1).alias("sample_index"))
    return generate.generate(r, num_completion=2, done=done.union(done)).select("request_id", "sample_index")


class _Flaky(generate.StubClient):
    """Fails at the first call of every conversation and turn of a run, then answers."""

    failed: set[tuple[str, str]] = set()

    def __init__(self, run: str):
        self.run = run

    def complete(self, messages, temperature=0.8, top_p=0.95, max_tokens=2048) -> str:
        said = super().complete(messages)
        if (self.run, said) not in self.failed:
            self.failed.add((self.run, said))
            raise TimeoutError("busy")
        return said


_ANSWERS = _ROUNDS + " SELECT request_id, sample_index::INT AS sample_index, r1 AS response_1, md5('system:s' || chr(10) || 'user:' || source || chr(10) || 'assistant:' || r1 || chr(10) || 'user:' || lang) AS response_2 FROM a"


@query(_ANSWERS)
def generate_retry(spark, d):
    g = generate.generate(_requests(spark, d), partial(_Flaky, uuid.uuid4().hex), num_completion=2, retries=2, wait_s=0)
    return generate.output_fields(generate.flatten_rounds(g, 2), ["request_id", "sample_index", "response_1", "response_2"])


@query(_ANSWERS)
def generate_saved(spark, d):
    """Saved in portions; the second start finds all answers there."""
    path = fresh_path(spark, "answers")
    generate.generate_saved(_requests(spark, d).filter("request_id % 2 = 0"), path, 2, num_completion=2)
    g = generate.generate_saved(_requests(spark, d), path, 2, num_completion=2)
    return generate.output_fields(generate.flatten_rounds(g, 2), ["request_id", "sample_index", "response_1", "response_2"])


# ---- Files ----


@query("SELECT doc_id, text, lang FROM documents")
def jsonl_round_trip(spark, d):
    """Written in two appends, in plain UTF-8."""
    path, x = fresh_path(spark, "jsonl"), _docs(spark, d).select("doc_id", "text", "lang")
    for k in range(2):
        sinks.write_jsonl(x.filter(F.col("doc_id") % 2 == k), path, append=k > 0)
    return jsonl.read_jsonl(spark, path, "doc_id long, text string, lang string")


@query("SELECT doc_id, text, lang FROM documents")
def jsonl_strict_ascii(spark, d):
    path = fresh_path(spark, "jsonl")
    sinks.write_jsonl(_docs(spark, d).select("doc_id", "text", "lang"), path, ascii_only=True)
    return jsonl.read_jsonl(spark, path, "doc_id long, text string, lang string", strict=True)


@query("SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id, lang FROM documents")
def jsonl_row_positions(spark, d):
    """Rows that are equal but for their place, in the order of several files."""
    path = fresh_path(spark, "jsonl")
    x = _docs(spark, d).select("doc_id", "lang").repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id")
    sinks.write_jsonl(x.drop("doc_id"), path)
    return jsonl.read_numbered(spark, path, "lang string", strict=True)


@query("SELECT lang, count(*) AS size, min(doc_id) AS first_row FROM documents GROUP BY lang UNION ALL SELECT source, count(*), min(doc_id) FROM documents GROUP BY source")
def statistics_csv(spark, d):
    path = fresh_path(spark, "statistics")
    for group in ("lang", "source"):
        sinks.append_statistics(stats.top_groups(_docs(spark, d), group, "doc_id", 1 << 30).withColumnRenamed(group, "lang"), path)
    return spark.read.csv(path, header=True, schema="lang string, size long, first_row long")
