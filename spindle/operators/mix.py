"""Mixing of triplet sources at given ratios."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import seeded
from ..sources.jsonl import joined_commit
from ..sources.store import stored
from . import balance

#: Most keys of a sample that are sent to every task.
BROADCAST_ROWS = 500_000

STYLES = ("descriptive", "lazy")


def largest_remainder(ratios: list[float], total: int) -> list[int]:
    """Whole parts of ``ratio * total``; what is left goes to the largest fractions, the first of equals first."""
    if abs(sum(ratios) - 1) >= 1e-6:
        raise ValueError("ratios must sum to 1")
    exact = [r * total for r in ratios]
    counts = [int(x) for x in exact]
    spare = total - sum(counts)
    if spare < 0 or spare > len(counts):
        raise ValueError("ratios don't fit the total")
    lucky = sorted(range(len(counts)), key=lambda i: counts[i] - exact[i])[:spare]
    return [n + (i in lucky) for i, n in enumerate(counts)]


def sample_rows(df: DataFrame, n: int, key: str, seed: int, source: str = "", clamp: bool = False) -> DataFrame:
    """``n`` rows without replacement, those of the least hash rank; fewer rows than that are an error, when the sample is
    computed, unless ``clamp``."""
    return balance.sample_rows(df, n, key, seeded(seed, F.lit(source), key), source, clamp)


def in_sample(df: DataFrame, drawn: DataFrame, n: int, *keys: str) -> DataFrame:
    """The rows of ``df`` whose keys were drawn, ``n`` at most: broadcast up to a bound. Spark sorts out the others at the scan,
    unless a generator or an aggregate lies between."""
    return df.join(F.broadcast(drawn) if n <= BROADCAST_ROWS else drawn, list(keys), "left_semi")


def style_label(model: str | None, style: str) -> Column:
    return F.lit(f"{model or 'unknown'}_{style}")


def as_style(df: DataFrame, style: str, model: str | None = None) -> DataFrame:
    """The ``mixed`` record of one instruction style; rows with an empty instruction go."""
    if style not in STYLES:
        raise ValueError(f"style must be one of {STYLES}")
    commit = joined_commit("commit") if df.schema["commit"].dataType.typeName() == "array" else F.col("commit")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return df.select(
        F.coalesce(commit.cast("string"), F.lit("")).alias("commit"),
        "code_snippet",
        text("code_before_purify").alias("code_before_purify"),
        text("code_after_purify").alias("code_after_purify"),
        text(f"instruct_{style}_purify").alias("instruct_purify"),
        style_label(model, style).alias("instr_type"),
    ).filter("instruct_purify <> ''")


def shuffled(df: DataFrame, seed: int, *key: str) -> DataFrame:
    """All rows in order of a hash rank: a random order that is the same on any partitioning."""
    return df.orderBy(seeded(seed, *key), *key)


def sample_and_mix(sources: list[DataFrame], styles: list[str], models: list[str | None], ratios: list[float], total: int, seed: int, key: str = "row_id", names: list[str] | None = None, shuffle: bool = True) -> DataFrame:
    """Samples each source by its share of ``total`` and joins the ``mixed`` records.

    Empty instructions go after sampling, so the result may be smaller than ``total``; a source given twice, once for
    each style, may give a row twice. The keys of a source, which are unique, are stored once, counted and drawn from;
    only drawn rows are read in full. The records come in a random order that depends on the seed alone, unless
    ``shuffle`` is off.
    """
    if not len(sources) == len(styles) == len(models) == len(ratios):
        raise ValueError("sources, styles, models and ratios must have the same length")
    names = names or [f"source{i}" for i in range(len(sources))]
    once = {id(df): df for df in sources}
    held = {k: stored(df.select(key), "keys") for k, df in once.items()}

    def drawn(df: DataFrame, n: int, name: str) -> DataFrame:
        keys = stored(sample_rows(held[id(df)], n, key, seed, name), "drawn")
        # The drawn rows are those of the least ranks. Unlike the join, this filter of the key passes the generators of a
        # source, so Spark makes no other row.
        rank = seeded(seed, F.lit(name), key)
        return in_sample(df.filter(rank <= F.lit(keys.agg(F.max(rank)).first()[0])), keys, n, key)

    parts = [as_style(drawn(df, n, name), style, model) for df, n, style, model, name in zip(sources, largest_remainder(ratios, total), styles, models, names, strict=True)]
    mixed = reduce(DataFrame.unionByName, parts)
    return shuffled(mixed, seed, "commit", "instr_type") if shuffle else mixed
