"""Seed snippets of new documents: an incremental job on a file stream.

    python -m jobs.ingest_seeds --config jobs/ingest_seeds.json [--documents PATH] [--output PATH] [--checkpoint PATH]

A corpus of code or text grows by files. Each start takes the files that no start before it has taken, cuts a seed snippet
out of every document that is long enough, leaves out snippets that are there already, and adds the rest to the table
of seeds from which prompts are made.
"""

from __future__ import annotations

import sys
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import ensured, language, log, logged, main
from spindle.functions.text import seeded, splitlines
from spindle.operators import seeds

SEEDS = "doc_id long, lang string, source string, n_lines int, snippet string, digest binary, batch long, language string"
REPORT = "read long, too_short long, repeated long, kept long, batch long"


def cut_seeds(docs: DataFrame, min_lines: int, max_lines: int, seed: int) -> DataFrame:
    """A snippet of each document that has ``min_lines`` lines; of equal snippets, the document of the least id stays."""
    long_ = seeds.long_enough(docs, "text", min_lines)
    lines = splitlines("text")
    d = long_.select("doc_id", "lang", "source", F.size(lines).alias("n_lines"), seeds.snippet(lines, seeded(seed, "doc_id"), min_lines, max_lines).alias("snippet"))
    d = d.withColumn("digest", F.unhex(F.sha2("snippet", 256)))
    one = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "lang", "source", "n_lines", "snippet")).alias("s")
    return d.groupBy("digest").agg(one).select(*[f"s.{c}" for c in ("doc_id", "lang", "source", "n_lines", "snippet")], "digest")


def files(path: str) -> str:
    """A pattern that only ``path`` matches: file streams take folders and patterns, but no path of a single file."""
    return path if any(c in path for c in "*?[{") else f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"


def read_seeds(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(SEEDS).parquet(f"{output}/seeds")


def read_report(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(REPORT).parquet(f"{output}/report")


def run(spark: SparkSession, documents: str, output: str, checkpoint: str, files_per_batch: int = 1000, min_lines: int = seeds.MIN_LINES, max_lines: int = seeds.MAX_LINES, seed: int = 42) -> list[dict[str, Any]]:
    """Takes what is new in ``documents``; returns the report of the batches that this run wrote.

    Spark's checkpoint holds which files were taken. A batch writes the partitions of its own number, ``seeds/batch=N/
    language=L`` and ``report/batch=N``, with dynamic overwrite: one that broke off is made again from the same files and
    replaces what it left. It compares its snippets with those of earlier batches only, so it always gives the same
    rows; a start without new files changes nothing. Output and checkpoint belong together.

    Documents without a text are too short. Repeated rows and ids give equal snippets or different ones, and only the
    snippets count. One that is repeated very often is combined map-side, and the comparison with earlier batches moves
    digests, not texts.
    """
    by_language = lambda df: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    ensured(spark, f"{output}/seeds", SEEDS, "batch", "language")
    ensured(spark, f"{output}/report", REPORT, "batch")
    done: list[int] = []

    def batch(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        earlier = read_seeds(session, output).filter(F.col("batch") < number).select("digest")
        found = cut_seeds(rows, min_lines, max_lines, seed).join(earlier, "digest", "left_anti")
        found = found.select("doc_id", "lang", "source", "n_lines", "snippet", "digest", F.lit(number).cast("long").alias("batch"), language("lang").alias("language"))
        by_language(found.repartition("language", F.pmod(F.xxhash64("digest"), F.lit(16)))).partitionBy("batch", "language").parquet(f"{output}/seeds")
        short = F.coalesce(F.size(splitlines("text")), F.lit(0)) < min_lines
        read = rows.agg(F.count(F.lit(1)).alias("read"), F.count_if(short).alias("too_short"))
        kept = read_seeds(session, output).filter(F.col("batch") == number).agg(F.count(F.lit(1)).alias("kept"))
        report = read.join(F.broadcast(kept)).select("read", "too_short", (F.col("read") - F.col("too_short") - F.col("kept")).alias("repeated"), "kept", F.lit(number).cast("long").alias("batch"))
        by_language(report).partitionBy("batch").parquet(f"{output}/report")
        done.append(number)

    log.info("read %s, write %s", documents, output)
    stream = spark.readStream.schema("doc_id long, text string, lang string, source string").option("maxFilesPerTrigger", files_per_batch).parquet(files(documents))
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return logged("batch", read_report(spark, output).filter(F.col("batch").isin(done)).orderBy("batch")) if done else []


if __name__ == "__main__":
    sys.exit(main(run, "ingest_seeds", ["documents", "output", "checkpoint"]))
