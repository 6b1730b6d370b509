"""The jobs as registered queries: each runs twice into one new folder, and its output is read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import build_training_set, ingest_seeds
from spindle.queries import LINES_SQL, SNIPPET_SQL, TEXTS_SQL, fill_sql
from spindle.sources.store import fresh_path


def job1_ingest_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fresh_path(spark, "job1")
    for _ in range(2):
        ingest_seeds.run(spark, f"{sf_dir}/documents.parquet", f"{base}/out", f"{base}/checkpoint")
    return ingest_seeds.read_seeds(spark, f"{base}/out").select("doc_id", "lang", "source", "n_lines", "snippet", F.lower(F.hex("digest")).alias("digest"), "language")


JOB1_SQL = f"""WITH {LINES_SQL}, {SNIPPET_SQL}, s AS (SELECT doc_id, n::INT AS n_lines, array_to_string(a[start + 1:start + size], chr(10)) AS snippet FROM placed)
SELECT doc_id, lang, source, n_lines, snippet, sha256(snippet) AS digest, coalesce(nullif(lang, ''), 'und') AS language
FROM s JOIN documents USING (doc_id) QUALIFY row_number() OVER (PARTITION BY snippet ORDER BY doc_id) = 1"""

TOTAL = 300


def job2_build_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fresh_path(spark, "job2")
    for _ in range(2):
        build_training_set.run(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet", base, total=TOTAL)
    said = lambda k: F.col("messages")[k]["content"]
    r = build_training_set.read_records(spark, base)
    return r.select("doc_id", said(0).alias("system"), said(1).alias("user"), said(2).alias("assistant"), "commit", "instr_type", "old_code", "new_code", "language")


JOB2_SQL = (
    TEXTS_SQL
    + """, good AS (SELECT doc_id, coalesce(nullif(d.lang, ''), 'und') AS language FROM diff d ANTI JOIN (SELECT doc_id FROM labels WHERE quality = 0 OR toxic = 1) USING (doc_id) WHERE removed BETWEEN 1 AND 70 AND hunk_num <= 7),
q AS (SELECT * FROM ("""
    + fill_sql("good", "language", "doc_id", TOTAL)
    + """ SELECT * FROM q)),
drawn AS (SELECT doc_id, language, target, row_number() OVER (PARTITION BY language ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM good JOIN q USING (language)),
e AS (SELECT doc_id, language, after AS old_code, before AS new_code, '```python' || chr(10) AS f FROM drawn JOIN texts USING (doc_id) WHERE rn <= target)
SELECT doc_id, 'You edit code as you are told.' AS system, '## Code Before:' || chr(10)
  || CASE WHEN ('0x' || substr(md5('42:' || doc_id || ':restore'), 1, 1))::BIGINT % 2 = 1 THEN f || old_code || chr(10) || '```' ELSE old_code END
  || chr(10) || '## Instruction:' || chr(10) || 'Restore the lines that are missing.' || chr(10) || '## Code After:' || chr(10) AS user,
  f || new_code || chr(10) || '```' AS assistant, doc_id::VARCHAR AS commit, 'restore' AS instr_type, old_code, new_code, language FROM e"""
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"job1_ingest_seeds": job1_ingest_seeds, "job2_build_training_set": job2_build_training_set}
SQL: dict[str, str] = {"job1_ingest_seeds": JOB1_SQL, "job2_build_training_set": JOB2_SQL}
