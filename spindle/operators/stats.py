"""Corpus statistics: diffs, histograms, topics, verb-object pairs, pass rates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.diff import COUNTS, diff_counts
from ..functions.phrases import verb_object_pairs
from ..functions.pieces import pieces
from ..sources.store import stored

#: Terms whose numbers are sent to every task, at some 100 bytes each.
HOT_TERMS = 8192


def with_diff(df: DataFrame, old: str = "old_code", new: str = "new_code") -> DataFrame:
    """Adds the five diff counts and ``changed``, their sum over lines. Null texts are empty.

    Arrow batches go through in pieces, so the other columns aren't converted, and Python holds a few texts at a time; on a
    stream it is the same. Columns that have the names of the counts are replaced.
    """
    df = df.drop(*COUNTS, "changed")
    kinds = df.select("*", *[F.lit(None).cast("int").alias(c) for c in COUNTS]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [batch.column(batch.schema.get_field_index(c)) for c in (old, new)]
            for start, n in pieces(*sides):
                some = zip(*(x.slice(start, n).to_pylist() for x in sides))
                counts = zip(*(diff_counts(a or "", b or "") for a, b in some))
                yield pa.RecordBatch.from_arrays([*batch.slice(start, n).columns, *(pa.array(c, pa.int32()) for c in counts)], [*batch.schema.names, *COUNTS])

    d = df.mapInArrow(run, kinds)
    return d.withColumn("changed", F.col("added") + F.col("removed") + F.col("modified"))


def filter_by_diff(df: DataFrame, old: str = "code_before_purify", new: str = "code_after_purify", max_modify_lines: int = 70, max_hunk_num: int = 7) -> DataFrame:
    """Rows that change at least one line, at most so many lines, and in at most so many hunks."""
    d = with_diff(df, old, new).filter((F.col("changed") > 0) & (F.col("changed") <= max_modify_lines) & (F.col("hunk_num") <= max_hunk_num))
    return d.select(*df.columns)


def diff_summary(d: DataFrame, max_lines: int = 70, max_hunks: int = 7) -> DataFrame:
    """One row for ``changed`` and one for ``hunk_num``: least, most, median, count and share above the limit."""
    def one(name: str, limit: int) -> Column:
        above = F.count_if(F.col(name) > limit)
        share = F.coalesce(above / F.nullif(F.count(F.lit(1)), F.lit(0)), F.lit(0.0))
        return F.struct(F.lit(name).alias("metric"), F.min(name).cast("long").alias("least"), F.max(name).cast("long").alias("most"), F.median(name).alias("median"), above.alias("above"), share.alias("ratio"))

    return d.agg(F.array(one("changed", max_lines), one("hunk_num", max_hunks)).alias("m")).select(F.inline("m"))


def histogram(d: DataFrame, value: str, width: int) -> DataFrame:
    """``bin_start, n`` from 0 to the largest value in steps of ``width``; the last bin is closed, empty bins count 0.

    One pass counts each value; the rest works on a row for each value.
    """
    by_value = d.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    bins = F.greatest(F.floor((F.max("v").over(Window.partitionBy()) + width - 1) / width), F.lit(1).cast("long"))
    placed = by_value.withColumn("bins", bins).groupBy("bins", F.least(F.floor(F.col("v") / width), F.col("bins") - 1).alias("b")).agg(F.sum("n").alias("n"))
    whole = placed.groupBy("bins").agg(F.map_from_entries(F.collect_list(F.struct("b", "n"))).alias("held"))
    every = whole.select("held", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bins") - 1)).alias("b"))
    return every.select((F.col("b") * width).cast("long").alias("bin_start"), F.coalesce(F.try_element_at("held", F.col("b")), F.lit(0)).cast("long").alias("n"))


def scatter(d: DataFrame, x: str, y: str) -> DataFrame:
    """Figure data of a scatter plot: ``x, y, n``, a row for each point that occurs."""
    return d.groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count(F.lit(1)).alias("n"))


def sunburst(counts: DataFrame) -> DataFrame:
    """Figure data of a sunburst over ``verb, object, count``: ``id, parent, label, value``, verbs within, objects around."""
    inner = counts.groupBy("verb").agg(F.sum("count").alias("value")).select(F.col("verb").alias("id"), F.lit("").alias("parent"), F.col("verb").alias("label"), "value")
    return inner.unionByName(counts.select(F.concat_ws("/", "verb", "object").alias("id"), F.col("verb").alias("parent"), F.col("object").alias("label"), F.col("count").alias("value")))


def n_groups(df: DataFrame, group: str) -> DataFrame:
    """``n_groups``: how many groups have rows; the rows without a topic, -1, are none."""
    return df.agg(F.count_distinct(F.when(F.col(group).cast("string") != "-1", F.col(group))).alias("n_groups"))


def top_groups(df: DataFrame, group: str, row_id: str, n: int = 20) -> DataFrame:
    """The ``n`` largest groups; the first to appear of equals first."""
    g = df.groupBy(group).agg(F.count(F.lit(1)).alias("size"), F.min(row_id).alias("first_row"))
    return g.orderBy(F.desc("size"), "first_row").limit(n)


def bag_of_words(df: DataFrame, key: str, tokens: str) -> DataFrame:
    return df.select(key, F.explode(tokens).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def term_dictionary(bag: DataFrame, term: str = "term") -> DataFrame:
    """``term, term_id, docs``: a number from 0 for every term of a bag, in the terms' order, and in how many rows it stands.

    The terms are counted, dealt in ranges and stored in order; a part's terms follow on those of the parts before, whose
    sizes are a row each. Nothing is collected, so the dictionary may be as large as the corpus makes it.
    """
    counted = bag.groupBy(term).agg(F.count(F.lit(1)).alias("docs"))
    parts = int(bag.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = counted.repartitionByRange(parts, term).sortWithinPartitions(term)
    ranged = stored(ranged.select(term, "docs", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "terms")
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = ranged.groupBy("part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    return ranged.join(F.broadcast(sizes), "part").select(term, (F.col("at") + F.col("shift")).alias("term_id"), "docs")


def with_term_ids(bag: DataFrame, dictionary: DataFrame, term: str = "term", hot: int = HOT_TERMS) -> DataFrame:
    """The rows of a bag with ``term_id`` in the place of the term.

    The ``hot`` terms that stand in most rows are sent to every task, so their rows stay where they are; those of the others,
    none of which has more than a ``hot``-th of all, meet the dictionary by a shuffle.
    """
    known = stored(dictionary, "dictionary")
    often = stored(known.orderBy(F.desc("docs"), term).limit(hot).select(F.col(term).alias("__often"), F.col("term_id").alias("__id")), "often")
    d = bag.join(F.broadcast(often), F.col(term) == F.col("__often"), "left")
    rest = d.filter("__id is null").drop("__often", "__id").join(known.select(term, "term_id"), term)
    settled = d.filter("__id is not null").drop("__often").withColumnRenamed("__id", "term_id")
    return settled.drop(term).unionByName(rest.drop(term))


def count_pairs(df: DataFrame, verb: str = "verb", obj: str = "object") -> DataFrame:
    return df.groupBy(F.col(verb).alias("verb"), F.col(obj).alias("object")).agg(F.count(F.lit(1)).alias("count"))


def top_pairs(counts: DataFrame, verbs: int = 20, objects: int = 10, drop_other: bool = True) -> DataFrame:
    """The most frequent objects of the most frequent verbs; with ``drop_other`` false, the rest of a verb as ``<other>``."""
    top = counts.groupBy("verb").agg(F.sum("count").alias("total")).orderBy(F.desc("total"), "verb").limit(verbs)
    by_count = Window.partitionBy("verb").orderBy(F.desc("count"), "object")
    ranked = counts.join(F.broadcast(top.select("verb")), "verb", "left_semi").withColumn("rn", F.row_number().over(by_count))
    if drop_other:
        return ranked.filter(F.col("rn") <= objects).drop("rn")
    return ranked.groupBy("verb", F.when(F.col("rn") <= objects, F.col("object")).otherwise("<other>").alias("object")).agg(F.sum("count").alias("count"))


def verb_objects(df: DataFrame, text: str, extractor: Callable[[str], list[tuple[str, str]]] = verb_object_pairs) -> DataFrame:
    """``verb, object`` rows of each text, by any extractor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in pieces(batch.column(0)):
                found = [p for t in batch.column(0).slice(start, n).to_pylist() for p in extractor(t or "")]
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.string()) for k in range(2)], ["verb", "object"])

    return df.select(text).mapInArrow(run, "verb string, object string")


def pass_at_1(df: DataFrame, problem: str, passed: str) -> DataFrame:
    """The mean over problems of the share of completions that pass."""
    per = df.groupBy(problem).agg(F.avg(F.col(passed).cast("int")).alias("p"))
    return per.agg(F.count(F.lit(1)).alias("problems"), F.avg("p").alias("pass_at_1"))
