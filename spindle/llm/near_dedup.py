"""MinHash near-dedup with odd sketches: banded candidates, XOR population counts, confirmation on full shingle sets."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, maybe_broadcast, slices, text_or_empty, written
from .graph import components
from .hashing import U, mixed, shingle_set

#: Bands and MinHash values in a band: a pair of similarity 0.8 shares no band with probability 2e-6, one of 0.85 1e-8;
#: very small sets with more (README).
BANDS, ROWS = 32, 5
#: Samples and bits of an odd sketch. A set of at most WHOLE shingles is its own sample.
SAMPLES, BITS, WHOLE = 4096, 4096, 2048
#: How far an estimate may lie below the bound, five deviations at the worst size (0.0092 and 0.0043) and more: of samples,
#: and of whole sets.
MARGIN, WHOLE_MARGIN = 0.05, 0.025
#: Members of a bucket that one task compares with as many others at a time, and shingles that they have together, about.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: A bucket with more members outside its largest component is parted by a second set of bands.
HOT = 32 * BLOCK


@lru_cache(maxsize=8)
def _edges(k: int) -> np.ndarray:
    return np.array([-(-(j << 64) // k) for j in range(k)], dtype=U)


@lru_cache(maxsize=1)
def _donors() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(11)).integers(0, BANDS * ROWS, (64, BANDS * ROWS))


@lru_cache(maxsize=1)
def _last_donors() -> np.ndarray:
    r = np.random.Generator(np.random.PCG64(12))
    return np.array([r.permutation(BANDS * ROWS) for _ in range(BANDS * ROWS)])


def _minima(h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """One-permutation MinHash of a sorted set: the place of the least value of each of k equal ranges, and which have one."""
    at = np.searchsorted(h, _edges(k))
    return at, at < np.append(at[1:], len(h))


def band_keys(h: np.ndarray) -> np.ndarray:
    """A key for each band; an empty range borrows from others that a fixed random table names, in the end from any."""
    at, full = _minima(h, BANDS * ROWS)
    value = h[np.minimum(at, len(h) - 1)]
    got = full.copy()
    for donors in _donors():
        if got.all():
            break
        need = ~got & full[donors]
        value[need] = value[donors[need]]
        got |= need
    empty = np.flatnonzero(~got)
    if len(empty):  # very small sets
        order = _last_donors()[empty]
        value[empty] = value[order[np.arange(len(empty)), full[order].argmax(1)]]
    v = value.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=U) + U(1)
    for r in range(ROWS):
        key = mixed(key * U(0x9E3779B97F4A7C15) + v[:, r])
    return key.view(np.int64)


def odd_sketch(h: np.ndarray) -> tuple[np.ndarray, int]:
    """Parity bitmap of the MinHash samples as int64 words, and the number of samples."""
    if len(h) > WHOLE:
        at, full = _minima(h, SAMPLES)
        h = h[at[full]]
    bits = (mixed(h + U(0x632BE59BD9B4E019)) % U(BITS)).astype(np.int64)
    odd = np.bincount(bits, minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64), len(h)


def estimate(ones: np.ndarray, k_a: np.ndarray, k_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Similarity from the ones of the XOR of two sketches, their numbers of samples, and the sizes of the sets.

    Samples that agree stand against the ranges in which the union has a value. Of whole sets that is the union itself; of
    samples, it is what a union of the size at the bound fills.
    """
    differ = -BITS / 2 * np.log(np.maximum(1 - 2 * ones / BITS, 1e-9))
    agree = (k_a + k_b - differ) / 2
    filled = SAMPLES * (1 - np.exp(-(n_a + n_b) / (1 + percent / 100) / SAMPLES))
    return agree / np.where((n_a <= WHOLE) & (n_b <= WHOLE), k_a + k_b - agree, filled)


def _likely(sketch_a: str, sketch_b: str, percent: int) -> Column:
    """Whether two sketches leave it open that the bound is met; a sample and a whole set can't be compared."""
    ones = F.aggregate(F.zip_with(sketch_a, sketch_b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    differ = F.lit(-BITS / 2) * F.log(F.greatest(1 - 2 * ones / BITS, F.lit(1e-9)))
    agree = (F.col("k_a") + F.col("k_b") - differ) / 2
    filled = SAMPLES * (1 - F.exp(-(F.col("n_a") + F.col("n_b")) / F.lit((1 + percent / 100) * SAMPLES)))
    whole_a, whole_b = F.col("n_a") <= WHOLE, F.col("n_b") <= WHOLE
    est = agree / F.when(whole_a, F.col("k_a") + F.col("k_b") - agree).otherwise(filled)
    return (whole_a != whole_b) | (est >= percent / 100 - F.when(whole_a, WHOLE_MARGIN).otherwise(MARGIN))


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """Per row of ``doc_id, text, digest``: ``doc_id, digest, n, set_hash, bands, sketch, k``; null beyond ``n`` where the set is
    empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ns, hashes, bands, sketches, ks = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                h = shingle_set(text, words)
                ns.append(len(h))
                if not len(h):
                    for x in (hashes, bands, sketches, ks):
                        x.append(None)
                    continue
                hashes.append(_set_hash(h))
                bands.append(band_keys(h))
                s, k = odd_sketch(h)
                sketches.append(s)
                ks.append(k)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(ns, pa.int64()), pa.array(hashes, pa.binary()), pa.array(bands, longs), pa.array(sketches, longs), pa.array(ks, pa.int32())], ["doc_id", "digest", "n", "set_hash", "bands", "sketch", "k"])

    return docs.mapInArrow(run, "doc_id long, digest binary, n long, set_hash binary, bands array<long>, sketch array<long>, k int")


def _set_hash(h: np.ndarray) -> bytes:
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``cid, hashes``: the sorted shingle hashes of each row of ``wanted``, which has ``cid, doc_id, set_hash, alone``.

    ``alone`` tells that no other row has the same set; of the others, several rows of ``docs`` may match.
    """
    found = docs.select("doc_id", "text").join(maybe_broadcast(wanted, wanted.count()), "doc_id").select("cid", "set_hash", "alone", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(t, words) for t in batch.column(3).to_pylist()]
            same = pa.array([_set_hash(h) == want for h, want in zip(sets, batch.column(1).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([h.tobytes() for h in sets], pa.binary())], ["cid", "alone", "hashes"]).filter(same)

    sets = written(found.mapInArrow(run, "cid long, alone boolean, hashes binary"), "found")
    once = sets.filter("not alone").groupBy("cid").agg(F.first("hashes").alias("hashes"))
    out = written(sets.filter("alone").select("cid", "hashes").unionByName(once), "sets")
    discard(sets)
    return out


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full shingle sets have 100 * intersection >= percent * union. ``pairs`` is a written table.

    Partners of one ``b`` come in lots of about BLOCK, each behind the set of ``b``: a document with very many partners
    is dealt to many tasks, and its set is sent once a lot.
    """
    lots = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("lots"))
    others = pairs.join(lots, "b").select("b", F.pmod(F.xxhash64("a"), F.col("lots")).cast("int").alias("lot"), F.col("a").alias("cid"))
    own = lots.select("b", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot")).join(sets.withColumnRenamed("cid", "b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        set_b = np.zeros(0, U)
        for batch in slices(batches):
            keep = []
            for a, held in zip(batch.column(2).to_pylist(), batch.column(3)):
                h = np.frombuffer(held.as_py(), U)
                if a is None:
                    set_b = h
                keep.append(a is not None and _near(h, set_b, percent))
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    rows = others.join(sets, "cid").select("b", "lot", F.col("cid").alias("a"), "hashes").unionByName(own.select("b", "lot", F.lit(None).cast("long").alias("a"), "hashes"))
    return rows.repartition("b", "lot").sortWithinPartitions("b", "lot", F.asc_nulls_first("a")).mapInArrow(run, "a long, b long")


def _near(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def _open_members(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """``key, sub, cid, component``: the members of buckets that hold several components.

    In a bucket of more than HOT members outside its largest component, which dissimilar sets with something in common
    may fill, each member takes a row for each band of a second, independent set: near sets share one of those nearly
    certainly, others seldom, so such a bucket is not compared as a whole.
    """
    known = labels.select(F.col("node").alias("cid"), "component")
    placed = members.join(known, "cid", "left").select("key", "cid", F.coalesce("component", "cid").alias("component"))
    placed = written(placed, "placed")
    sizes = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m")).groupBy("key").agg(F.sum("m").alias("all"), F.max("m").alias("main"))
    parted = written(sizes.filter("all > main").select("key", (F.col("all") - F.col("main") > HOT).alias("hot")), "parted")
    opened = placed.join(parted, "key")
    plain = opened.filter("not hot").select("key", F.lit(0).cast("long").alias("sub"), "cid", "component")
    if parted.filter("hot").isEmpty():
        return written(plain, "open")

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys = [band_keys(np.sort(mixed(np.frombuffer(h.as_py(), U) ^ U(0xA0761D6478BD642F)))) for h in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], ["cid", "subs"])

    hot = opened.filter("hot")
    subs = sets.join(hot.select("cid").distinct(), "cid", "left_semi").select("cid", "hashes").mapInArrow(second, "cid long, subs array<long>")
    dealt = written(hot.join(subs, "cid").select("key", F.explode("subs").alias("sub"), "cid", "component"), "dealt")
    several = dealt.groupBy("key", "sub").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least < most").select("key", "sub")
    return written(plain.unionByName(dealt.join(several, ["key", "sub"], "left_semi")), "open")


def _runs(rest: DataFrame, percent: int) -> DataFrame:
    """The members of open buckets, a row for each pair of blocks that a member is part of: ``key, sub, lo, hi, mine`` and
    its own columns.

    Sizes are classed by powers of the bound, as sets of classes that aren't neighbours can't be near. The largest
    component of a bucket and the rest are dealt apart, both in blocks of about BLOCK members and BLOCK_SHINGLES: blocks
    of the largest component meet those of the rest only, so a bucket of very many copies and a few others costs one row
    each, and not one for each block.
    """
    step = -math.log(percent / 100)
    size_class = F.floor(F.log(F.col("n")) / F.lit(step)) if step else F.col("n")
    in_key = rest.groupBy("key", "sub", "component").agg(F.count(F.lit(1)).alias("m")).groupBy("key", "sub").agg(F.max_by("component", F.struct("m", "component")).alias("main"))
    d = rest.join(in_key, ["key", "sub"]).withColumn("unit", (size_class * 2 + F.when(F.col("component") == F.col("main"), 0).otherwise(1)).cast("long"))
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    units = d.groupBy("key", "sub", "unit").agg(blocks.alias("blocks"))
    other = units.select(F.col("key").alias("__key"), F.col("sub").alias("__sub"), F.col("unit").alias("other"), F.col("blocks").alias("others"))
    near = (F.abs(F.floor(F.col("unit") / 2) - F.floor(F.col("other") / 2)) <= 1) & ((F.col("unit") % 2 == 1) | (F.col("other") % 2 == 1))
    partners = units.join(other, (F.col("key") == F.col("__key")) & (F.col("sub") == F.col("__sub")) & near).drop("__key", "__sub")
    d = d.join(partners, ["key", "sub", "unit"]).withColumn("__block", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    code = lambda unit, block: F.shiftleft(F.col(unit), 31) + block
    d = d.withColumn("mine", code("unit", F.pmod(F.xxhash64("cid"), F.col("blocks")))).withColumn("theirs", code("other", F.col("__block")))
    return d.select("key", "sub", F.least("mine", "theirs").alias("lo"), F.greatest("mine", "theirs").alias("hi"), "mine", "cid", "component", "n", "k", "bands", "sketch", "hashes")


def _links(runs: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between components: a spanning forest of them for each run, which one task compares.

    Sketches name the pairs that may be near, each in the first band that it shares only. The most similar ones are
    confirmed first, on the full sets that the rows carry; a pair whose ends are joined already isn't looked at.
    """

    def compare(rows: list[tuple]) -> list[tuple]:
        key, _, lo, hi = rows[0][:4]
        mine, cid, comp, n, k = (np.array([r[c] for r in rows]) for c in range(4, 9))
        bands, sketch = np.array([r[9] for r in rows]), np.array([r[10] for r in rows]).view(U)
        root = {c: c for c in comp.tolist()}
        tree: list[tuple] = []

        def top(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        def joined(found: list[tuple]) -> None:
            for _, i, j in sorted(found):
                x, y = top(int(comp[i])), top(int(comp[j]))
                if x != y and _near(np.frombuffer(rows[i][11], U), np.frombuffer(rows[j][11], U), percent):
                    root[x] = y
                    tree.append((int(cid[i]), int(cid[j])))

        found: list[tuple] = []
        for i in np.flatnonzero(mine == lo).tolist():
            j = np.flatnonzero((mine == hi) & (comp != comp[i]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])))
            j = j[j > i] if lo == hi else j
            if not len(j):
                continue
            est = estimate(np.bitwise_count(sketch[j] ^ sketch[i]).sum(1), k[j], k[i], n[j], n[i], percent)
            whole = n[j] <= WHOLE
            near = (whole != (n[i] <= WHOLE)) | (est >= percent / 100 - np.where(whole, WHOLE_MARGIN, MARGIN))
            j, est = j[near], est[near]
            if len(j):
                first = bands[i][(bands[j] == bands[i]).argmax(1)] == key
                found += [(-e, i, x) for e, x in zip(est[first].tolist(), j[first].tolist())]
            if len(found) > 64 * BLOCK:
                joined(found)
                found = []
        joined(found)
        return tree

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out = lambda links: pa.RecordBatch.from_arrays([pa.array([x[c] for x in links], pa.int64()) for c in (0, 1)], ["a", "b"])
        for batch in slices(batches):
            found = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[-1][:4] != row[:4]:
                    found += compare(held)
                    held = []
                held.append(row)
            yield out(found)
        if held:
            yield out(compare(held))

    return runs.repartition("key", "sub", "lo", "hi").sortWithinPartitions("key", "sub", "lo", "hi").mapInArrow(run, "a long, b long")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when 100 * intersection >= percent * union of their sets of word shingles; ``component_id`` is
    the smallest id that links reach, and the document of that id is kept.

    Equal sets collapse to one row first, so that copies, repeated rows included, are compared once. MinHash bands deal
    these into buckets. Every member of a bucket is compared with the bucket's first: odd sketches, whose XOR counts
    estimate high similarities closely, drop what is clearly below, and full shingle sets confirm the rest. Components of
    these links settle most buckets; in those that still hold several components, all pairs between components are
    compared by sketch in bounded blocks, and confirmed there until all that is near is joined. So no link between
    different components is lost for want of a comparison, and pairs inside a component are never listed. The texts are
    read twice: for the signatures, and for the full sets of what shares a bucket. Sets are sets of 64-bit hashes of the
    shingles.

    Null text is an empty set, and empty sets link with nothing. Ids name documents: rows that repeat id and text get the
    same result; an id with several texts has a row, and a group, for each. A row without an id stays alone, with null
    ``component_id``, and is kept. An empty table gives no rows; extra columns are not read.
    """
    return _grouped(docs, id_col, text_col, words, percent).drop("digest")


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, digest: bool = False) -> DataFrame:
    """:func:`groups`, and the SHA-256 of the text if ``digest``."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    d = d.select("*", (F.unhex(F.sha2("text", 256)) if digest else F.lit(None).cast("binary")).alias("digest"))
    sigs = written(signatures(d, words).withColumn("row", F.monotonically_increasing_id()), "signatures")
    named = sigs.filter("n > 0 and doc_id is not null")
    # A set that several rows have is named by the row of the least id.
    classes = named.groupBy("set_hash").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    classes = written(classes.select("set_hash", F.col("first.row").alias("cid"), F.col("first.doc_id").alias("least")), "classes")
    classes = maybe_broadcast(classes, classes.count())
    reps = named.join(classes, "set_hash", "left").filter("cid is null or cid = row").select(F.col("row").alias("cid"), "doc_id", "set_hash", F.col("cid").isNull().alias("alone"), "n", "k", "bands", "sketch")
    bands = reps.select("cid", F.explode("bands").alias("key"))
    buckets = bands.groupBy("key").agg(F.min("cid").alias("rep"), F.max("cid").alias("far"), F.count(F.lit(1)).alias("size")).filter("rep < far").drop("far")
    members = written(bands.join(buckets, "key"), "members")
    side = lambda x: reps.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("k").alias(f"k_{x}"), F.col("sketch").alias(f"s_{x}"))
    stars = members.filter("cid <> rep").select(F.col("cid").alias("a"), F.col("rep").alias("b")).distinct()
    stars = stars.join(side("a"), "a").join(side("b"), "b").filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    stars = written(stars.filter(_likely("s_a", "s_b", percent)).select("a", "b"), "stars")
    several = members.filter("size > 2").select("key", "cid")
    compared = written(stars.select(F.col("a").alias("cid")).union(stars.select("b")).union(several.select("cid")).distinct(), "compared")
    wanted = written(reps.join(maybe_broadcast(compared, compared.count()), "cid", "left_semi").select("cid", "doc_id", "set_hash", "alone"), "wanted")
    sets = shingle_sets(d, wanted, words)
    links = written(confirmed(stars, sets, percent), "confirmed")
    labels = components(links)
    opened = _open_members(several, labels, sets)
    rest = opened.join(reps.select("cid", "n", "k", "bands", "sketch"), "cid").join(sets, "cid")
    more = written(_links(_runs(rest, percent), percent), "more")
    discard(stars, compared, opened)
    if not more.isEmpty():
        links = links.union(more)
        labels = components(links)
    # The nodes are rows; a component is called by the least id in it.
    ids = wanted.select(F.col("cid").alias("node"), "doc_id")
    placed = written(labels.join(ids, "node"), "labels")
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    known = placed.join(least, "component").select(F.col("node").alias("cid"), "component_id")
    out = sigs.select("doc_id", "digest", "n", "set_hash", "row").join(classes, "set_hash", "left")
    out = out.select("doc_id", "digest", "n", F.coalesce("least", "doc_id").alias("least"), F.coalesce("cid", "row").alias("cid")).join(known, "cid", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component_id", "least"))
    out = out.select("doc_id", "digest", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that :func:`groups` keeps, with all columns: one document of each group.

    Rows go by id and text, so an id with several texts loses those only that another document stands for. Rows without
    an id stay; rows that repeat id and text stay or go together. An empty table gives no rows; columns of any name are
    kept.
    """
    gone = _grouped(docs, id_col, text_col, words, percent, digest=True).filter("not kept").select("doc_id", "digest").distinct()
    gone = written(gone, "gone")
    own = F.unhex(F.sha2(F.coalesce(docs[text_col], F.lit("")), 256))
    return docs.join(maybe_broadcast(gone, gone.count()), (docs[id_col].cast("long") == gone["doc_id"]) & (own == gone["digest"]), "left_anti")
