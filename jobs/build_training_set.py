"""A balanced fine-tuning set of edits: a batch job from texts and ratings to records by language.

    python -m jobs.build_training_set --config jobs/build_training_set.json [--documents PATH] [--labels PATH] [--output PATH]

Each document that no rating calls poor or toxic becomes an edit that restores lines which are missing from it. Edits that
change too much go, the others are drawn in even shares from the languages, and written as chat records.
"""

from __future__ import annotations

import sys
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import language, log, logged, main
from spindle.operators.balance import balance_by_group
from spindle.operators.edits import line_edits
from spindle.operators.finetune import SYSTEM, format_records
from spindle.operators.stats import filter_by_diff
from spindle.sources.store import stored

#: Ratings up to this number go to every executor; more are shuffled.
BROADCAST_ROWS = 500_000
_TURNS = "messages array<struct<role:string,content:string>>"
_META = "commit string, instr_type string, old_code string, new_code string, language string"
RECORDS = {"share_gpt": f"doc_id long, {_TURNS}, {_META}", "alpaca": f"doc_id long, instruction string, system string, output string, {_META}"}


def usable(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents without a rating of poor quality or toxicity."""
    bad = labels.filter("quality = 0 or toxic = 1").select("doc_id").distinct()
    return docs.join(F.broadcast(bad) if labels.count() <= BROADCAST_ROWS else bad, "doc_id", "left_anti")


def read_records(spark: SparkSession, output: str, layout: str = "share_gpt") -> DataFrame:
    return spark.read.schema(RECORDS[layout]).parquet(f"{output}/records")


def run(spark: SparkSession, documents: str, labels: str, output: str, total: int = 10_000, max_lines: int = 70, max_hunks: int = 7, seed: int = 42, instruction: str = "Restore the lines that are missing.", system: str = SYSTEM, layout: str = "share_gpt") -> list[dict[str, Any]]:
    """Writes ``records/language=L`` and ``report``, and returns the report: what each language had and gave.

    The diffs of all are made once, and only ids and languages of what they leave are kept to draw from; the texts of the
    drawn ones are read again. Draws are hash ranks of seed and id, so a run over the same tables writes the same rows. Both
    tables are replaced as a whole, so that no language of an earlier run is left over.

    Documents without an id, or with an empty text, make no edit. Of rows that repeat an id one counts. With fewer edits
    than ``total`` all are taken.
    """
    docs = spark.read.schema("doc_id long, text string, lang string").parquet(documents).filter("doc_id is not null")
    rated = spark.read.schema("doc_id long, quality int, toxic int").parquet(labels)
    log.info("read %s and %s, write %s", documents, labels, output)
    docs = docs.withColumn("language", language("lang")).drop("lang")
    changed = lambda df: filter_by_diff(line_edits(df, "doc_id", "text", "code_after_purify", "code_before_purify").drop("text"), max_modify_lines=max_lines, max_hunk_num=max_hunks)
    ids = stored(changed(usable(docs, rated)).groupBy("doc_id").agg(F.min("language").alias("language")), "edits")
    drawn = stored(balance_by_group(ids, "language", "doc_id", total=total, seed=seed), "drawn")  # of total rows at most
    rows = changed(docs.join(F.broadcast(drawn) if total <= BROADCAST_ROWS else drawn, ["doc_id", "language"], "left_semi"))
    rows = rows.groupBy("doc_id", "language").agg(F.min(F.struct("code_before_purify", "code_after_purify")).alias("e")).select("doc_id", "language", "e.*")
    mixed = rows.select("doc_id", "language", F.col("doc_id").cast("string").alias("commit"), "code_before_purify", "code_after_purify", F.lit(instruction).alias("instruct_purify"), F.lit("restore").alias("instr_type"))
    records = format_records(mixed, layout, seed, system=system, keep=("doc_id", "language"))
    records.repartition("language", F.pmod(F.xxhash64("doc_id"), F.lit(16))).write.mode("overwrite").partitionBy("language").parquet(f"{output}/records")

    count = lambda df, name: df.groupBy("language").agg(F.count(F.lit(1)).alias(name))
    report = count(docs, "documents")
    for one in (count(ids, "edits"), count(read_records(spark, output, layout), "records")):
        report = report.join(one, "language", "left")
    report.na.fill(0).coalesce(1).write.mode("overwrite").parquet(f"{output}/report")
    return logged("language", spark.read.parquet(f"{output}/report").orderBy("language"))


if __name__ == "__main__":
    sys.exit(main(run, "build_training_set", ["documents", "labels", "output"]))
