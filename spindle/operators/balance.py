"""Quotas and balanced samples by group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import seeded

#: First-level parts of a group, so that a hot group isn't ranked in one task.
SALTS = 32


def group_sizes(df: DataFrame, group: str, row_id: str) -> DataFrame:
    """``group, size, first_row``: rows of each group, and its first row for the order of appearance."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("size"), F.min(row_id).alias("first_row"))


def water_fill(sizes: DataFrame, total: int, group: str) -> DataFrame:
    """Adds ``target``: equal shares of ``total``, where small groups give what they can't fill to the others.

    Closed form. In order of size, group i of n with S rows in smaller groups keeps all rows exactly if
    ``size * (n - i) <= total - S``; the others share the rest evenly, and the first to appear take one more while a
    remainder lasts. If all rows fit, all stay. Only the table of groups, a row each, is ordered as a whole.
    """
    by_size = Window.orderBy("size", "first_row", group)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = sizes.withColumn("__i", F.row_number().over(by_size) - 1)
    s = s.withColumn("__n", F.count(F.lit(1)).over(every))
    s = s.withColumn("__less", F.coalesce(F.sum("size").over(by_size.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = s.withColumn("__locked", F.col("size") * (F.col("__n") - F.col("__i")) <= F.lit(total) - F.col("__less"))
    s = s.withColumn("__left", F.lit(total) - F.coalesce(F.sum(F.when(F.col("__locked"), F.col("size"))).over(every), F.lit(0)))
    s = s.withColumn("__open", F.sum(F.when(F.col("__locked"), 0).otherwise(1)).over(every))
    s = s.withColumn("__place", F.sum(F.when(F.col("__locked"), 0).otherwise(1)).over(Window.orderBy("first_row", group).rowsBetween(Window.unboundedPreceding, -1)))
    more = F.when(F.coalesce("__place", F.lit(0)) < F.col("__left") % F.col("__open"), 1).otherwise(0)
    target = F.when(F.col("__locked"), F.col("size")).otherwise(F.floor(F.col("__left") / F.col("__open")) + more).cast("long")
    return s.withColumn("target", target).select(*sizes.columns, "target")


def sample_by_target(df: DataFrame, targets: DataFrame, group: str, row_id: str, seed: int) -> DataFrame:
    """``target`` rows of each group, those of the least hash rank: the same on any partitioning.

    ``targets`` has ``group, size, target``. Ranks are uniform, so rows beyond the ``target / size`` quantile and ten
    deviations are dropped where they lie: what is moved and ordered is about the sample, however large the group. The
    rest is ranked in two levels: the least of each salted part first, then the least of those. Row ids are unique; a group
    that keeps too few rows, which ids that repeat may do, is an error.
    """
    t = targets.select(F.col(group).alias("__group"), F.col("size").alias("__size"), F.col("target").alias("__target"))
    d = df.join(t, df[group].eqNullSafe(F.col("__group"))).withColumn("__rank", seeded(seed, row_id))
    return _ranked(d, [F.col("__group")], row_id).select(*df.columns)


def _ranked(d: DataFrame, groups: list[Column], row_id: str) -> DataFrame:
    """The ``__target`` rows of least ``__rank`` of each group of ``__size`` rows."""
    share = (F.col("__target") + 10 * F.sqrt(F.col("__target")) + 50) / F.col("__size")
    place = F.conv(F.substring("__rank", 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    d = d.filter(place <= share).withColumn("__salt", F.pmod(F.xxhash64(row_id), F.lit(SALTS)))
    order = [F.col("__rank"), F.col(row_id)]
    d = d.withColumn("__rn", F.row_number().over(Window.partitionBy(*groups, "__salt").orderBy(*order))).filter("__rn <= __target")
    every = Window.partitionBy(*groups)
    d = d.withColumn("__rn", F.row_number().over(every.orderBy(*order))).withColumn("__have", F.count(F.lit(1)).over(every))
    short = F.raise_error(F.lit("the row ids of a group repeat too often to sample it"))
    return d.filter(F.when(F.col("__have") < F.least("__size", "__target"), short.cast("boolean")).otherwise(F.col("__rn") <= F.col("__target")))


def sample_rows(df: DataFrame, n: int, key: str, rank: Column, source: str = "", clamp: bool = False) -> DataFrame:
    """``n`` rows, those of the least ``rank``; fewer rows than that are an error in the plan unless ``clamp``."""
    size = df.agg(F.count(F.lit(1)).alias("__size"))
    short = F.raise_error(F.concat(F.lit("only "), F.col("__size").cast("string"), F.lit(f" rows to sample {n} from {source}"))).cast("long")
    target = F.least("__size", F.lit(n)) if clamp else F.when(F.col("__size") < n, short).otherwise(F.lit(n).cast("long"))
    d = df.crossJoin(F.broadcast(size.withColumn("__target", target))).withColumn("__rank", rank)  # with one row
    return _ranked(d, [F.lit(1)], key).select(*df.columns)


def in_input_order(df: DataFrame, row_id: str) -> DataFrame:
    """A sample in the order of its input; a sink that is to keep the order writes it as it comes."""
    return df.orderBy(row_id)


def balance_by_group(df: DataFrame, group: str, row_id: str, total: int | None = None, per_group: int | None = None, seed: int = 42) -> DataFrame:
    """A sample of ``total`` rows spread evenly over the groups, or of at most ``per_group`` rows of each."""
    if (total is None) == (per_group is None):
        raise ValueError("give either total or per_group")
    sizes = group_sizes(df, group, row_id)
    targets = water_fill(sizes, total, group) if total is not None else sizes.withColumn("target", F.least("size", F.lit(per_group)).cast("long"))
    return sample_by_target(df, targets, group, row_id, seed)
