"""URL filter: a sort-merge range join of reversed-host keys with rule intervals, swept with a stack of nested rules."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import maybe_broadcast, slices, written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Ends the host in a key: no host and no path holds it.
_END = "#"
#: Canonical keys of URLs that one partition of the sweep is to hold.
KEYS_A_PART = 500_000


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def _key(labels: Column, path: Column) -> Column:
    """Host labels, the last first, then the path: what a rule fits begins with the rule's own key."""
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit(_END), path)


def _swept(rows: DataFrame) -> DataFrame:
    """``part, key, near, start, rule, length, verdict`` of each URL key with the innermost rule opened in its own partition,
    and a row with ``first`` set for each partition: the least key in it.

    A rule's interval is all that begins with its key, so intervals nest, and the stack holds the rules that are prefixes
    of the current key, one inside the other: never more than a key has characters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple] = []
        begun = False
        for batch in slices(batches, 4096):
            out: list[tuple] = []
            for part, key, is_url, near, start, rule, length, verdict in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun:
                    out.append((part, key, None, None, None, None, None, True))
                    begun = True
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if is_url:
                    out.append((part, key, near, start, *(stack[-1][1:] if stack else (None, None, None)), False))
                else:
                    stack.append((key, rule, length, verdict))
            kinds = [pa.int32(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], ["part", "key", "near", "start", "rule", "length", "verdict", "first"])

    return rows.mapInArrow(run, "part int, key string, near string, start string, rule string, length long, verdict string, first boolean")


def clean_rules(rules: DataFrame) -> DataFrame:
    """``host, path, verdict``, one row a rule: hosts lower-cased, null path empty, ``block`` before ``allow`` where a rule is
    there twice. Rules without a host or a verdict go."""
    r = rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    return r.filter("host <> '' and verdict is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", keys_a_part: int = KEYS_A_PART) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict``.

    ``rules`` has ``host, path, verdict``. A rule fits its host and all subdomains if the URL's path begins with the
    rule's. The longest rule wins, by the characters of host and path together, of equals the one with the longer host;
    a URL that no rule fits has a null ``rule`` and the ``default`` verdict.

    A verdict depends on the last labels of the host, as many as a rule has at most, and on the first characters of the
    path, as many as a rule has at most. These canonical parts are made distinct first, combined map-side, so a host or a
    URL with a third of all rows is one row from there on. Each then gives a key for every suffix of its host: labels
    reversed, then the path. A rule's own key is a prefix of the keys that it fits, so in key order it is an interval.
    Keys and rules are sorted together by range, and each partition is swept once with a stack of the rules that are
    open. Rules opened in an earlier partition that still cover the first key of a later one are found by a join of that
    key's prefixes with the rules, a row a partition; they lie outside all rules opened in it, so they count only where
    none of those is open. The best rule over the suffixes of a host is taken, and joined to the rows: broadcast up to a
    counted bound, else shuffled with the rows on the larger side.

    Null URLs, and those without ``://``, have empty host and path, which no rule fits. Repeated rows and ids, null ids,
    ties and extra columns, of whatever name, are fine; an empty table gives no rows, without rules all is ``default``.
    """
    r = written(clean_rules(rules).select("*", F.split("host", r"\.").alias("labels")), "rules")
    most = r.agg(F.coalesce(F.max(F.size("labels")), F.lit(0)), F.coalesce(F.max(F.length("path")), F.lit(0))).first()
    d = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    if not most[0]:
        return d.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    d = d.withColumns({"near": F.when(F.col("host") == "", "").otherwise(F.substring_index("host", ".", -most[0])), "start": F.substring("path", 1, most[1])})
    urls = written(d.filter("near <> ''").select("near", "start").distinct(), "urls")
    n = urls.count()
    labels = F.split("near", r"\.")
    keyed = urls.select("near", "start", labels.alias("labels"), F.explode(F.sequence(F.lit(1), F.size(labels))).alias("n"))
    keyed = keyed.select(_key(F.slice("labels", -F.col("n"), F.col("n")), F.col("start")).alias("key"), F.lit(True).alias("is_url"), "near", "start", *[F.lit(None).cast(k).alias(c) for c, k in (("rule", "string"), ("length", "long"), ("verdict", "string"))])
    rule = F.concat("host", "path")
    # Longest first, then the longer host: one number that tells both.
    length = F.length(rule).cast("long") * (1 << 24) + F.length("host")
    opened = r.select(_key(F.col("labels"), F.col("path")).alias("key"), F.lit(False).alias("is_url"), *[F.lit(None).cast("string").alias(c) for c in ("near", "start")], rule.alias("rule"), length.alias("length"), "verdict")
    spark = pages.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // keys_a_part))
    ranged = keyed.unionByName(opened).repartitionByRange(parts, "key", "is_url", "near").sortWithinPartitions("key", "is_url")
    swept = written(_swept(ranged.select(F.spark_partition_id().alias("part"), "key", "is_url", "near", "start", "rule", "length", "verdict")), "swept")
    firsts = swept.filter("first").select("part", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n"), "key").select("part", F.expr("substring(key, 1, n)").alias("key"))
    carried = firsts.join(opened.select("key", "rule", "length", "verdict"), "key").groupBy("part").agg(F.sort_array(F.collect_list(F.struct(F.length("key").alias("n"), "key", "rule", "length", "verdict")), asc=False).alias("open"))
    # A row a partition, with no more rules than a key has characters.
    found = swept.filter("not first").join(F.broadcast(carried), "part", "left")
    outer = F.get(F.filter("open", lambda o: F.startswith(F.col("key"), o["key"])), F.lit(0))
    own = F.struct(F.col("length"), F.col("rule"), F.col("verdict"))
    best = F.when(F.col("rule").isNotNull(), own).when(outer.isNotNull(), F.struct(outer["length"].alias("length"), outer["rule"].alias("rule"), outer["verdict"].alias("verdict")))
    best = found.select("near", "start", best.alias("best")).filter("best is not null").groupBy("near", "start").agg(F.max("best").alias("best"))
    best = best.select(F.col("near").alias("__near"), F.col("start").alias("__start"), F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    best = written(best, "verdicts")
    got = d.join(maybe_broadcast(best, best.count()), (F.col("near") == F.col("__near")) & (F.col("start") == F.col("__start")), "left")
    return got.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
