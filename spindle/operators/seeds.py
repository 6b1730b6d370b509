"""Seed snippets from commits, and prompts filled with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.diff import unified_diff
from ..functions.text import hash_int, seeded, splitlines
from ..sources.store import stored
from ..sources.templates import get_prompts
from .mix import in_sample

MIN_LINES, MAX_LINES = 5, 15


def valid_commits(df: DataFrame) -> DataFrame:
    return df.filter("old_contents <> '' and new_contents <> '' and commit <> ''")


def reject_reason() -> Column:
    """Why a commit can't be rewritten, the first reason in order; null if it can."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return F.when(blank("old_contents"), "old_contents").when(blank("new_contents"), "new_contents").when(blank("message"), "message")


def snippet(lines: Column, rank: Column, least: int = MIN_LINES, most: int = MAX_LINES) -> Column:
    """Consecutive lines: a length from ``least`` to ``most`` or all there are, then a place for it, both from the rank."""
    n = F.size(lines)
    size = F.lit(least) + hash_int(rank, F.least(F.lit(most), n) - least + 1)
    start = hash_int(rank, n - size + 1, 9)
    return F.array_join(F.slice(lines, (start + 1).cast("int"), size.cast("int")), "\n")


def long_enough(df: DataFrame, text: str = "old_contents", least: int = MIN_LINES) -> DataFrame:
    return df.filter(F.size(splitlines(text)) >= least)


def indexed(df: DataFrame, key: str, seed: int | str) -> DataFrame:
    """Adds ``idx`` from 0, in order of a hash rank, without one task for all: places within 256 parts by the rank's first
    digits, after the sizes of the parts before."""
    d = df.withColumn("__rank", seeded(seed, key)).withColumn("__part", F.substring("__rank", 1, 2))
    sizes = d.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy("__rank", key)) - 1
    return d.withColumn("__place", place).join(F.broadcast(sizes), "__part").withColumn("idx", F.col("__base") + F.col("__place")).drop("__rank", "__part", "__place", "__base")


def pairs(spark, n_pairs: int, n_rows: int, seed: int) -> DataFrame:
    """``i, left_idx, right_idx``: two different rows for each pair, drawn anew each time."""
    if n_rows < 2:
        raise ValueError("pairs need two valid rows")
    rank = seeded(seed, F.lit("pair"), "i")
    left = hash_int(rank, F.lit(n_rows))
    right = (left + 1 + hash_int(rank, F.lit(n_rows - 1), 9)) % n_rows
    return spark.range(n_pairs).withColumnRenamed("id", "i").select("i", left.alias("left_idx"), right.alias("right_idx"))


def assign_oneshot(df: DataFrame, oneshot: DataFrame, key: str, oneshot_key: str, seed: int) -> DataFrame:
    """Each row with one example, by a hash of its key. The examples are few and broadcast up to a checked number."""
    n = oneshot.count()
    if not n:
        raise ValueError("there is no example")
    shots = oneshot.withColumn("__shot", F.row_number().over(Window.orderBy(oneshot_key)) - 1)
    d = df.withColumn("__shot", hash_int(seeded(seed, F.lit("shot"), key), F.lit(n)).cast("int"))
    return d.join(F.broadcast(shots) if n <= 100_000 else shots, "__shot").drop("__shot")


def filled(template: str, values: dict[str, Column]) -> Column:
    """A template with its ``{placeholders}`` replaced; values are not searched for placeholders."""
    import re

    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.coalesce(values[p], F.lit("")) if k % 2 else F.lit(p) for k, p in enumerate(parts) if k % 2 or p])


def create_prompts(commits: DataFrame, oneshot: DataFrame, sample_num: int, seed: int, version: str = "v5.1", min_lines: int = MIN_LINES, max_lines: int = MAX_LINES) -> DataFrame:
    """Exactly ``sample_num`` prompts, each from snippets of two commits and one example.

    Only the names of the commits are ordered to draw from; the texts of the drawn ones are then read. Of rows that repeat
    a commit's name, each may be drawn, and the text of the least message and contents is taken.
    """
    if version != "v5.1":
        raise ValueError("only v5.1 extends snippets")
    system, rounds = get_prompts(version)
    spark = commits.sparkSession
    good = long_enough(valid_commits(commits), "old_contents", min_lines)
    ids = stored(indexed(good.select("commit"), "commit", seed), "ids")
    drawn = pairs(spark, sample_num, ids.count(), seed)
    name = lambda s: ids.select(F.col("idx").alias(f"{s}_idx"), F.col("commit").alias(f"{s}_commit"))
    drawn = stored(drawn.join(name("left"), "left_idx").join(name("right"), "right_idx"), "drawn")
    wanted = drawn.select(F.explode(F.array("left_commit", "right_commit")).alias("commit")).distinct()
    texts = in_sample(good.select("commit", "message", "old_contents"), wanted, 2 * sample_num, "commit")
    texts = stored(texts.groupBy("commit").agg(F.min(F.struct("message", "old_contents")).alias("t")), "texts")
    side = lambda s: texts.select(F.col("commit").alias(f"{s}_commit"), F.col("t.message").alias(f"{s}_message"), F.col("t.old_contents").alias(f"{s}_old"))
    d = drawn.join(side("left"), "left_commit").join(side("right"), "right_commit")
    cut = lambda s: snippet(splitlines(f"{s}_old"), seeded(seed, F.lit(s), "i"), min_lines, max_lines)
    d = d.withColumn("__one", cut("left")).withColumn("__two", cut("right"))
    d = assign_oneshot(d, oneshot, "i", "code_before", seed)
    values = {"code_snippet_1": F.col("__one"), "code_snippet_2": F.col("__two"), "code_before_shot": F.col("code_before"), "desc_instr_shot": F.col("instruct_descriptive"), "lazy_instr_shot": F.col("instruct_lazy")}
    return d.select(
        "i", F.array("left_commit", "right_commit").alias("commit"), F.lit(system).alias("system"), F.array(*[filled(r, values) for r in rounds]).alias("user"),
        F.array("__one", "__two").alias("code_snippet"), F.array("left_message", "right_message").alias("commit_message"),
    )


def rewrite_prompts(commits: DataFrame, oneshot: DataFrame, seed: int, shuffle: bool = False) -> DataFrame:
    """A prompt for each valid commit, with its unified diff and one example."""
    system, (template,) = get_prompts("v5.9")
    d = assign_oneshot(commits.filter(reject_reason().isNull()), oneshot, "commit", "code_before", seed)
    values = {"old_code": F.col("old_contents"), "diff": unified_diff("old_contents", "new_contents"), "commit_message": F.col("message"), "desc_instr_shot": F.col("instruct_descriptive"), "lazy_instr_shot": F.col("instruct_lazy")}
    out = d.select("commit", F.lit(system).alias("system"), filled(template, values).alias("user"), F.col("old_contents").alias("old_code"), F.col("new_contents").alias("new_code"), F.col("message").alias("commit_message"))
    return out.orderBy(seeded(seed, "commit"), "commit") if shuffle else out
