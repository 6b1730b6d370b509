"""Mixing sources to target weights by pivotal dependent rounding; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, maybe_broadcast, written

#: Documents that one leaf of the reduction tree rounds, and residuals that an inner node does.
FANOUT = 128


def n_words(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """One row per source: ``source, source_size, weight, target``.

    Sources in code-point order (null last) get the weights in turn, again and again, and share the total size by
    weight. Targets stop at ``most`` times the source's size; the excess is reshared by weight until none is above. This
    is water filling, solved in one pass: a source is capped exactly if it is once all that reach their cap at a lower
    level are. Only the table of sources, a row each, is ordered as a whole.
    """
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * F.lit(most))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    s = s.withColumn("weights_left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("capped", F.col("cap") * F.col("weights_left") <= F.col("left") * F.col("weight"))
    # The first source that isn't capped sets the level for itself and all after it.
    s = s.withColumn("level", F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), (F.col("left") / F.col("weights_left")).alias("level")))).over(every)["level"])
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight")))
    return s.select("source", "source_size", "weight", target.cast("double").alias("target"))


def _uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30))


def _pivot(a: Column, x: Column, seed: Column) -> Column:
    """One pivotal step on two open items: moves words from one to the other until the share of one is 0 or 1.

    With shares p and sizes s, p_a s_a + p_x s_x stays as it is; the way is drawn so that each share keeps its mean.
    """
    down_a = F.least(a["p"] * a["size"], (F.lit(1.0) - x["p"]) * x["size"])  # words that can go from a to x
    up_a = F.least((F.lit(1.0) - a["p"]) * a["size"], x["p"] * x["size"])  # and from x to a
    moved = F.when(_uniform(seed, a["doc_id"], x["doc_id"], a["h"], x["h"]) * (down_a + up_a) < up_a, -down_a).otherwise(up_a)
    near = lambda p: F.when(p < 1e-9, F.lit(0.0)).when(p > 1 - 1e-9, F.lit(1.0)).otherwise(p)
    with_p = lambda it, p: F.struct(*[(p if f == "p" else it[f]).alias(f) for f in ("h", "doc_id", "size", "whole", "p")])
    return F.struct(with_p(a, near(a["p"] + moved / a["size"])).alias("a"), with_p(x, near(x["p"] - moved / x["size"])).alias("x"))


ITEM = "struct<h:bigint,doc_id:bigint,size:bigint,whole:bigint,p:double>"
_STATE = f"struct<open:{ITEM},done:array<{ITEM}>>"


def _rounded(items: Column, seed: Column) -> Column:
    """Folds a bounded array of open items to its settled items and at most one that is still open."""
    is_open = lambda it: (it["p"] > 0) & (it["p"] < 1)

    def step(acc, x):
        pair = _pivot(acc["open"], x, seed)
        after = lambda pr: F.struct(
            F.when(is_open(pr["a"]), pr["a"]).when(is_open(pr["x"]), pr["x"]).alias("open"),
            F.concat(acc["done"], F.filter(F.array(pr["a"], pr["x"]), lambda it: ~is_open(it))).alias("done"),
        )
        fresh = F.struct(x.alias("open"), acc["done"].alias("done"))
        # transform over a one-element array evaluates the pair once
        return F.when(acc["open"].isNull(), fresh).otherwise(F.get(F.transform(F.array(pair), after), F.lit(0))).cast(_STATE)

    return F.aggregate(items, F.struct(F.lit(None).cast(ITEM).alias("open"), F.array().cast(f"array<{ITEM}>").alias("done")).cast(_STATE), step)


def _settled(items: Column, seed: Column) -> Column:
    """Settles every item of a bounded array, the largest first, each against all that come after it as one unit.

    The pivotal step is the same: words move between the item and the others together until the item's share is 0 or 1,
    and the way is drawn so that each share keeps its mean. The others' shares rise by one part of what each lacks, or fall
    by one part of what each has, so an affine map of the first shares, ``rise + keep * p``, tells them all. Only where the
    others together can't take or give enough is an item drawn alone; so what is left over is about one of the smallest.
    """
    words = lambda it: it["p"] * it["size"]
    one = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))  # noqa: E731  evaluates the value once
    start = F.struct(F.lit(0.0).alias("rise"), F.lit(1.0).alias("keep"), F.aggregate(items, F.lit(0.0), lambda s, it: s + words(it)).alias("mass"), F.aggregate(items, F.lit(0.0), lambda s, it: s + it["size"]).alias("room"), F.array().cast(f"array<{ITEM}>").alias("done"))

    def step(acc, it):
        p = F.least(F.greatest(acc["rise"] + acc["keep"] * it["p"], F.lit(0.0)), F.lit(1.0))
        room = acc["room"] - it["size"]
        now = F.struct(p.alias("p"), F.least(F.greatest(acc["mass"] - p * it["size"], F.lit(0.0)), room).alias("mass"), room.alias("room"))
        return one(now, lambda n: one(_drawn(n, it), lambda d: after(acc, it, n, d)))

    def _drawn(n, it):
        down, up = F.least(n["p"] * it["size"], n["room"] - n["mass"]), F.least((1.0 - n["p"]) * it["size"], n["mass"])
        u = _uniform(seed, F.lit("unit"), it["doc_id"], it["h"])
        moved = F.when(u * (down + up) < up, -down).otherwise(up)  # words to the item
        alone = _uniform(seed, F.lit("alone"), it["doc_id"], it["h"])
        near = n["p"] + moved / it["size"]
        return F.struct(moved.alias("moved"), F.when(near < 1e-9, 0.0).when(near > 1 - 1e-9, 1.0).when(alone < near, 1.0).otherwise(0.0).alias("p"))

    def after(acc, it, n, d):
        gain = F.when(d["moved"] < 0, -d["moved"] / F.greatest(n["room"] - n["mass"], F.lit(1e-300))).otherwise(0.0)
        loss = F.when(d["moved"] > 0, d["moved"] / F.greatest(n["mass"], F.lit(1e-300))).otherwise(0.0)
        keep = F.least(F.greatest(1.0 - gain - loss, F.lit(0.0)), F.lit(1.0))
        final = F.struct(*[(d["p"] if f == "p" else it[f]).alias(f) for f in ("h", "doc_id", "size", "whole", "p")])
        return F.struct((keep * acc["rise"] + gain).alias("rise"), (keep * acc["keep"]).alias("keep"), (n["mass"] - d["moved"]).alias("mass"), n["room"].alias("room"), F.concat(acc["done"], F.array(final)).alias("done"))

    kind = f"struct<rise:double,keep:double,mass:double,room:double,done:array<{ITEM}>>"
    return F.aggregate(items, start.cast(kind), lambda acc, it: step(acc, it).cast(kind))["done"]


#: Rows of one id and size that are numbered in one go.
_ALIKE = 4096


def _numbered(d: DataFrame) -> DataFrame:
    """``d`` with ``k``, which tells rows of one id, source and size apart: copies of a row are counted, then dealt out in
    blocks, so that one id with very many rows lies in no single task."""
    counts = written(d.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "alike")
    few = counts.filter(F.col("n") <= _ALIKE).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).drop("n")
    blocks = counts.filter(F.col("n") > _ALIKE).withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _ALIKE)))).repartition("doc_id", "b")
    many = blocks.withColumn("k", F.explode(F.sequence(F.col("b") * _ALIKE, F.least((F.col("b") + 1) * _ALIKE, F.col("n")) - 1))).drop("n", "b")
    return few.unionByName(many)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, seed: int = 42, fanout: int = FANOUT) -> DataFrame:
    """One row per document: ``doc_id, size, source, source_size, target, copies, taken``.

    ``size`` is the number of words. Every document of a source has the same expected number of copies, target over
    source size; its whole part is certain and its fraction is rounded by pivotal sampling. Leaves of about ``fanout``
    documents of one source pair their fractions, move words between them at random until one is 0 or 1, and leave at
    most one open document each; the open ones of ``fanout`` leaves meet in the next node of a reduction tree, until one
    is left in each source. One leaf of each source, ``fanout`` documents by hash, stays out of the tree: it takes up what
    the last open document leaves over (:func:`_settled`), from its largest document to its smallest. So a source's words
    differ from its target by about one of its small documents, unless one document outweighs that leaf. No task gathers
    more than a node, however large the source. Draws are hashes of the seed and the pair: reruns agree.

    Null text has size 0; documents of size 0 take nothing. Null sources are one source, last in order. Repeated rows are
    documents of their own. An empty table gives no rows; extra columns are not read.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), n_words(text_col).alias("size"))
    d = written(d, "sizes")
    counts = d.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    s = source_targets(d, weights, most)
    s = written(s.join(counts, s.source.eqNullSafe(counts.source)).select(s.source, "source_size", "target", "n_docs", F.xxhash64(F.lit(seed), s.source, s.source.isNull()).alias("sid")), "sources")
    sources = s.count()
    joined = _numbered(d).join(maybe_broadcast(s.withColumnRenamed("source", "__source"), sources, 100_000), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.when(F.col("size") > 0, F.floor(share + 1e-9)).otherwise(0).cast("long")
    p = F.when(F.col("size") > 0, F.greatest(F.lit(0.0), share - whole)).otherwise(0.0)
    h = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"), F.col("k"))
    item = F.struct(h.alias("h"), "doc_id", "size", whole.alias("whole"), F.when(p > 1e-9, p).otherwise(0.0).alias("p"))
    joined = joined.select("doc_id", "source", "size", "source_size", "target", "n_docs", "sid", item.alias("it"))
    fixed = joined.filter("it.p = 0").select("doc_id", "size", "source", "source_size", "target", F.col("it.whole").alias("copies"))
    leaves = F.ceil(F.col("n_docs") / F.lit(fanout)).cast("long")
    dealt = written(joined.filter("it.p > 0").select("sid", F.pmod("it.h", leaves).alias("node"), "it"), "dealt")
    last, level = dealt.filter("node = 0").select("sid", "it"), dealt.filter("node > 0")
    widest = s.agg(F.max(F.ceil(F.col("n_docs") / fanout))).first()[0] or 1
    # Node numbers go up to ``top``; the level of node 0 alone ends the tree.
    settled, top, depth = None, widest - 1, 0
    while top > 0 or depth:
        nodes = level.groupBy("sid", "node").agg(F.sort_array(F.collect_list("it")).alias("items"))
        nodes = written(nodes.select("sid", "node", _rounded(F.col("items"), F.lit(seed + depth)).alias("r")), f"level{depth}")
        part = nodes.select("sid", F.explode("r.done").alias("it"))
        settled = part if settled is None else settled.unionByName(part)
        level = nodes.filter("r.open is not null").select("sid", F.floor(F.col("node") / fanout).cast("long").alias("node"), F.col("r.open").alias("it"))
        if top == 0:
            break
        top, depth = top // fanout, depth + 1
    by_size = lambda a, b: F.when(a["size"] != b["size"], F.when(a["size"] > b["size"], -1).otherwise(1)).when(a["h"] != b["h"], F.when(a["h"] < b["h"], -1).otherwise(1)).otherwise(0)
    ends = last.unionByName(level.select("sid", "it")).groupBy("sid").agg(F.array_sort(F.collect_list("it"), by_size).alias("items"))
    ends = written(ends.select("sid", _settled(F.col("items"), F.lit(seed)).alias("done")), "ends")
    part = ends.select("sid", F.explode("done").alias("it"))
    settled = part if settled is None else settled.unionByName(part)
    by_source = s.withColumnRenamed("sid", "__sid")
    rounded = settled.join(maybe_broadcast(by_source, sources, 100_000), F.col("sid") == F.col("__sid")).select(
        F.col("it.doc_id").alias("doc_id"), F.col("it.size").alias("size"), "source", "source_size", "target", (F.col("it.whole") + F.round("it.p").cast("long")).alias("copies")
    )
    return fixed.unionByName(rounded).withColumn("taken", F.col("copies") * F.col("size"))


def apply_mix(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with each row as often as ``mixed``, made of the same rows, takes it.

    Where an id names one row, they meet by id. Rows that share an id, null included, are told apart by source and size; of
    those alike in all three, which :func:`mix` may take differently often, the first few take one copy more, numbered
    in salted lots, so that all copies together are those of the mix however often a row repeats. Columns of any name
    are kept; an empty table gives no rows.
    """
    by_id = mixed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max("copies").alias("copies")).filter("rows > 1 or copies > 0")
    by_id = written(by_id, "take")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id_col).cast("long").alias("id"))
    held = held.join(maybe_broadcast(by_id, by_id.count()), F.col("id").eqNullSafe(F.col("doc_id")))
    taken = lambda d: d.filter("copies > 0").select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")
    out = taken(held.filter("rows = 1"))
    if by_id.filter("rows > 1").isEmpty():
        return out
    doc = F.col("doc")
    many = held.filter("rows > 1").select("doc", "id", doc[source_col].alias("src"), F.regexp_count(F.coalesce(doc[text_col], F.lit("")), F.lit(WORD)).cast("long").alias("words"))
    alike = mixed.join(by_id.filter("rows > 1").select(F.col("doc_id").alias("id")), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    alike = alike.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"), F.min("copies").alias("least"), F.sum("copies").alias("all"))
    alike = written(alike, "alike")
    same = F.col("id").eqNullSafe(F.col("doc_id")) & F.col("src").eqNullSafe(F.col("source")) & (F.col("words") == F.col("size"))
    many = many.join(maybe_broadcast(alike, alike.count()), same).withColumn("key", F.struct("id", "src", "words"))
    many = written(many.select("doc", "key", "n", "least", "all", F.monotonically_increasing_id().alias("row")).withColumn("lot", F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / _ALIKE))), "many")
    lots = many.groupBy("key", "lot").agg(F.count(F.lit(1)).alias("own"))
    before = F.coalesce(F.sum("own").over(Window.partitionBy("key").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lots = lots.select("key", "lot", before.alias("before"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("key", "lot").orderBy("row"))
    # The copies of one row and another alike differ by one at most.
    copies = F.col("least") + F.when(place <= F.col("all") - F.col("n") * F.col("least"), 1).otherwise(0)
    return out.unionByName(taken(many.join(lots, ["key", "lot"]).withColumn("copies", copies)))
