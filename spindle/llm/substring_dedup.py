"""Suffix-array dedup: removal of byte strings of a least length that stand elsewhere too."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, slices, text_or_empty, written
from .hashing import U, prefix_sums, ranges

#: Bytes of text that one task sorts at a time, but for a larger single group; and windows that are hashed at a time.
SHARD_BYTES, PIECE = 1 << 20, 1 << 20
#: Contexts of one key that are sorted in one task; more are dealt anew by a longer key.
GROUP = 2048


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups the windows of ``length`` bytes by anchor: ``anchor digest, span digest, first window, number of windows,
    place of the anchor``.

    A window's anchor is its substring of ``gram`` bytes with the least hash, the leftmost of equals, so equal windows have
    equal anchors at equal offsets. A span is what the windows of one anchor cover.
    """
    sums = prefix_sums(data)
    at = np.arange(len(data) - gram + 1)
    h = ranges(sums, at, at + gram)
    key = (h & U(0xFFFFFFFF00000000)) | at.astype(U)
    w = length - gram + 1
    x = np.full(-(-len(key) // w) * w, np.iinfo(np.uint64).max, U)
    x[: len(key)] = key
    x = x.reshape(-1, w)
    left = np.minimum.accumulate(x, axis=1).ravel()
    right = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(key) - w + 1
    pick = (np.minimum(right[:n], left[w - 1 : w - 1 + n]) & U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], pick[1:] != pick[:-1]]))
    count = np.diff(np.append(first, n))
    spans = ranges(sums, first, first + count + length - 1)
    return h[pick[first]], spans, first, count, pick[first]


def suffix_order(data: np.ndarray, cap: int, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``want`` (ascending, each of ``cap`` bytes or more) in order of their first ``cap`` bytes, ties in
    text order; and the length that each shares with the one before it, up to ``cap``.

    Prefix doubling from eight bytes on. The ranks of all rounds are kept, so common lengths come from them by halving.
    """

    def dense(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        in_order = key[order]
        rank = np.empty(len(key), np.uint32)
        rank[order] = np.cumsum(np.concatenate([[False], in_order[1:] != in_order[:-1]])).astype(np.uint32)
        return rank

    n, size = len(data), 1
    pad = np.concatenate([data, np.zeros(cap, np.uint8)])
    key = pad.astype(U)
    while size < 8:
        key = (key[:-size] << U(8 * size)) | key[size:]
        size *= 2
    ranks = {8: dense(key[:n])}
    while size * 2 <= cap:
        after = np.zeros(n, U)
        after[: n - size] = ranks[size][size:]
        after[: n - size] += U(1)
        ranks[size * 2] = dense((ranks[size].astype(U) << U(32)) | after)
        size *= 2
    top = ranks[size]
    order = np.argsort((top[want].astype(U) << U(32)) | top[want + cap - size], kind="stable")
    a, b = want[order[:-1]], want[order[1:]]
    shared = np.zeros(len(a), np.int64)
    for step in sorted(ranks, reverse=True):
        i = np.flatnonzero(shared < cap)
        i = i[ranks[step][np.minimum(a[i] + shared[i], n - 1)] == ranks[step][np.minimum(b[i] + shared[i], n - 1)]]
        shared[i] += step
    for _ in range(7):
        i = np.flatnonzero(shared < cap)
        i = i[pad[a[i] + shared[i]] == pad[b[i] + shared[i]]]
        shared[i] += 1
        if not len(i):
            break
    return order, np.concatenate([np.zeros(min(1, len(order)), np.int64), np.minimum(shared, cap)])


def _smaller_before(place: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """For suffixes in suffix order: the length shared with the nearest one before whose ``place`` is smaller, 0 if none.

    The nearest smaller position comes by jumps: what lies between a suffix and its candidate is larger, so where the
    candidate is larger too, the candidate's own candidate is next. All suffixes jump together. ``shared`` is with the
    suffix before; the least along the way is what is shared.
    """
    at, least = np.arange(len(place)) - 1, shared.copy()
    open_ = np.flatnonzero((at >= 0) & (place[at] > place))
    while len(open_):
        via = at[open_]
        least[open_], at[open_] = np.minimum(least[open_], least[via]), at[via]
        open_ = open_[(at[open_] >= 0) & (place[at[open_]] > place[open_])]
    return np.where(at >= 0, least, 0)


def factors(data: np.ndarray, cap: int, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factor of the suffixes at ``want``, up to ``cap`` bytes.

    The longest match of a suffix with any that begins earlier in the text is with one of two: in suffix order the nearest
    before and the nearest after it whose position is smaller. Likewise with larger positions for later matches.
    """
    order, shared = suffix_order(data, cap, want)
    back = np.append(shared[1:], 0)[::-1] if len(shared) else shared
    out = []
    for place in (order, -order):
        long_ = np.zeros(len(order), np.int64)
        long_[order] = np.maximum(_smaller_before(place, shared), _smaller_before(place[::-1], back)[::-1])
        out.append(long_)
    return out[0], out[1]


def repeated_windows(contexts: list[bytes], twice: list[bool], length: int, keep_first: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each context, in order of place: which of its windows of ``length`` bytes stand elsewhere too (with ``keep_first``:
    earlier), for its first copy and for all others. Contexts that are there ``twice`` or more take part twice, the second
    time behind all first copies."""
    texts = [*contexts, *(c for c, t in zip(contexts, twice) if t)]
    sizes = np.array([len(t) for t in texts])
    counts = sizes - length + 1
    owner = np.repeat(np.arange(len(texts)), counts)
    want = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + (np.cumsum(sizes) - sizes)[owner]
    previous, following = factors(np.frombuffer(b"".join(texts), np.uint8), length, want)
    hit = previous >= length if keep_first else (previous >= length) | (following >= length)
    parts = np.split(hit, np.cumsum(counts)[:-1])
    seconds = iter(parts[len(contexts) :])
    return [(own, next(seconds) if t else own[:0]) for own, t in zip(parts, twice)]


def _cuts(flags: np.ndarray, length: int, at: int = 0) -> list[dict]:
    """Byte ranges covered by the flagged windows, relative to ``at`` before the first."""
    step = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [{"b": at + x, "e": at + y - 1 + length} for x, y in zip(step[::2].tolist(), step[1::2].tolist())]


_CUTS = "array<struct<b:long,e:long>>"
_CUTS_ARROW = pa.list_(pa.struct([("b", pa.int64()), ("e", pa.int64())]))
_CONTEXT = "key long, span long, times long, kinds long, doc_id long, rid long, start long, n long, lo long, hi long, bytes binary"
_DECIDED = f"key long, span long, doc_id long, rid long, start long, first {_CUTS}, rest {_CUTS}"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [f.split()[0] for f in schema.split(", ")]
    kind = lambda n: pa.binary() if n == "bytes" else _CUTS_ARROW if n in ("first", "rest") else pa.int64()
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind(n)) for c, n in enumerate(names)], names)


def _sorted_shards(contexts: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """Decides contexts by the factor arrays; those of one key are sorted together."""

    def settle(rows: list[tuple]) -> list[tuple]:
        rows.sort(key=lambda r: (r[4], r[5], r[6], r[0]))
        rows = [r for k, r in enumerate(rows) if not k or (r[0], *r[4:7]) != (rows[k - 1][0], *rows[k - 1][4:7])]  # a row that repeats id and text
        hits = repeated_windows([r[10] for r in rows], [r[2] > 1 for r in rows], length, keep_first)
        out = [(r[0], r[1], r[4], r[5], r[6], _cuts(own, length), _cuts(rest, length)) for r, (own, rest) in zip(rows, hits)]
        return [r for r in out if r[5] or r[6]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= SHARD_BYTES and held[-1][0] != row[0]:
                    yield _batch(settle(held), _DECIDED)
                    held, size = [], 0
                held.append(row)
                size += len(row[10])
        if held:
            yield _batch(settle(held), _DECIDED)

    return contexts.repartition("key").sortWithinPartitions("key").mapInArrow(run, _DECIDED)


_PART = "key2 long, span2 long, key long, span long, at long, times long, doc_id long, rid long, start long, n long, lo long, hi long, bytes binary"


def _split(hot: DataFrame, length: int) -> DataFrame:
    """Each context of a very common key as two with longer keys.

    All windows of a context hold its key, ``bytes[lo:hi]``, and what else they hold lies to the left or right of it. Those
    that hold half of it or more to the left get a key that goes so far to the left, the others one that goes to the right.
    Equal windows have the key at equal offsets, so they get equal keys again; after some rounds a key is a whole window.
    """

    def digest(x: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little", signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for key, span, times, _, doc, rid, start, n, lo, hi, data in zip(*(c.to_pylist() for c in batch.columns)):
                rest = length - (hi - lo)
                half = (rest + 1) // 2
                lefts = min(max(lo - half + 1, 0), n)  # windows that begin half or more before the key
                for side, a, b, x, y in ((b"l", 0, lefts, lo - half, hi), (b"r", lefts, n, lo, hi + rest - half + 1)):
                    if a < b:
                        part = data[a : b - 1 + length]
                        rows.append((digest(side + key.to_bytes(8, "little", signed=True) + data[x:y]), digest(part), key, span, a, times, doc, rid, start + a, b - a, x - a, y - a, part))
            yield _batch(rows, _PART)

    return hot.mapInArrow(run, _PART)


def _decided(contexts: DataFrame, length: int, keep_first: bool, group: int) -> DataFrame:
    """What of each context is repeated: ``key, span``, its place, and the byte ranges of its first copy and of the others.

    Keys of more than ``group`` contexts are dealt anew: parts that are equal fall together to one with the sum of their
    times, the parts are decided in the same way, and what is decided goes back to the contexts that they come from.
    """
    out = _sorted_shards(contexts.filter(F.col("kinds") <= group), length, keep_first)
    hot = contexts.filter(F.col("kinds") > group)
    if hot.isEmpty():
        return out
    parts = written(_split(hot, length), "parts")
    place = F.struct("doc_id", "rid", "start", "key", "span")
    alike = parts.groupBy("key2", "span2").agg(F.sum("times").alias("sum"), F.min(place).alias("own"))
    per_key = alike.groupBy("key2").agg(F.count(F.lit(1)).alias("kinds"), F.sum("sum").alias("all")).filter("all > 1").drop("all")
    alike = written(alike.join(per_key, "key2"), "alike")
    own = parts.withColumn("own", place).join(alike, ["key2", "span2", "own"])
    names = [f.split()[0] for f in _CONTEXT.split(", ")]
    below = own.select(F.col("key2").alias("key"), F.col("span2").alias("span"), F.col("sum").alias("times"), *names[3:])
    found = written(_decided(written(below, "contexts"), length, keep_first, group), "decided")
    found = found.select(F.col("key").alias("key2"), F.col("span").alias("span2"), F.struct("doc_id", "rid", "start").alias("own"), "first", "rest")
    moved = lambda cuts: F.transform(cuts, lambda c: F.struct((c["b"] + F.col("at")).alias("b"), (c["e"] + F.col("at")).alias("e")))
    back = parts.drop("bytes").join(found, ["key2", "span2"]).withColumn("first", F.when(F.struct("doc_id", "rid", "start") == F.col("own"), F.col("first")).otherwise(F.col("rest")))
    back = back.select("key", "span", "doc_id", "rid", (F.col("start") - F.col("at")).alias("start"), moved(F.col("first")).alias("first"), moved(F.when(F.col("times") > 1, F.col("rest")).otherwise(F.array().cast(_CUTS))).alias("rest"))
    back = back.groupBy("key", "span", "doc_id", "rid", "start").agg(F.flatten(F.collect_list("first")).alias("first"), F.flatten(F.collect_list("rest")).alias("rest"))
    return out.unionByName(back)


def repeated_ranges(docs: DataFrame, length: int = 400, keep_first: bool = False, gram: int = 0, group: int = GROUP) -> DataFrame:
    """Byte ranges ``doc_id, rid, begin, finish`` of ``docs`` (``doc_id, rid, text``) covered by repeated strings; they may overlap.

    Windows of ``length`` bytes are grouped by a content-chosen anchor, about one in 140 bytes, so that equal windows,
    wherever they stand, meet at one anchor digest. Digests that occur once have no repeats. Equal spans around an anchor
    are counted, combined map-side, so common passages and large groups of copies cost a row per task, and only the first
    brings its bytes to be sorted, as itself and once more for its copies; what is decided for them goes back to all copies.
    The different spans of a digest meet in one shard; spans that have equals only are sorted where they lie. There the
    suffix array to ``length`` bytes, by prefix doubling, and the previous and next smaller positions in it give longest
    previous and next factors, and a window is repeated where one of them reaches ``length``. Digests with more than
    ``group`` different spans are dealt anew by longer keys, as often as it takes (:func:`_split`).
    """
    if length < 8:
        raise ValueError("length must be 8 or more")
    gram = gram or max(1, min(128, length // 3))

    def pieces(data: np.ndarray) -> Iterator[tuple]:
        for at in range(0, len(data) - length + 1, PIECE):
            fp, span, first, count, _ = anchors(data[at : at + PIECE + length - 1], length, gram)
            yield fp.view(np.int64), span.view(np.int64), first + at, count

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            cols: list[list] = [[], [], [], [], [], []]
            for doc, rid, text in zip(*(c.to_pylist() for c in batch.columns)):
                for fp, span, first, count in pieces(np.frombuffer(text.encode(), np.uint8)):
                    for col, x in zip(cols, (fp, span, np.full(len(fp), doc), np.full(len(fp), rid), first, count)):
                        col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in cols], ["key", "span", "doc_id", "rid", "start", "n"])

    found = written(docs.mapInArrow(find, "key long, span long, doc_id long, rid long, start long, n long"), "anchors")
    spans = found.groupBy("key", "span").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("doc_id", "rid", "start", "n")).alias("own"))
    spans = written(spans, "spans")
    per_key = spans.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.sum("times").alias("all")).filter("all > 1").drop("all")
    needed = spans.join(per_key, "key").select("key", "span", "times", "kinds", "own.*")
    by_doc = needed.groupBy("doc_id", "rid").agg(F.collect_list(F.struct("key", "span", "times", "kinds", "start", "n")).alias("needs"))

    def alone(doc: int, rid: int, data: bytes, needs: list[dict]) -> list[tuple]:
        """Decides spans that have equals only, in stretches of spans that follow each other."""
        needs.sort(key=lambda x: x["start"])
        out, k = [], 0
        while k < len(needs):
            stretch, begin = [needs[k]], needs[k]["start"]
            end = begin + needs[k]["n"]
            while (k := k + 1) < len(needs) and needs[k]["start"] == end and end - begin < SHARD_BYTES:
                stretch.append(needs[k])
                end += needs[k]["n"]
            ((own, rest),) = repeated_windows([data[begin : end - 1 + length]], [True], length, keep_first)
            for x in stretch:
                part = slice(x["start"] - begin, x["start"] - begin + x["n"])
                out.append((x["key"], x["span"], None, None, doc, rid, x["start"], None, None, None, None, _cuts(own[part], length), _cuts(rest[part], length)))
        return out

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            for doc, rid, text, needs in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode()
                rows = alone(doc, rid, data, [x for x in needs if x["kinds"] == 1])
                for x in (x for x in needs if x["kinds"] > 1):
                    part, lo, hi = data[x["start"] : x["start"] + x["n"] + length - 1], None, None
                    if x["kinds"] > group:
                        lo = int(anchors(np.frombuffer(part, np.uint8), length, gram)[4][0])
                        hi = lo + gram
                    rows.append((x["key"], x["span"], x["times"], x["kinds"], doc, rid, x["start"], x["n"], lo, hi, part, None, None))
                for k in range(0, len(rows), 4096):
                    yield _batch(rows[k : k + 4096], f"{_CONTEXT}, first {_CUTS}, rest {_CUTS}")

    whole = docs.join(by_doc, ["doc_id", "rid"]).select("doc_id", "rid", "text", "needs")
    placed = written(whole.mapInArrow(cut, f"{_CONTEXT}, first {_CUTS}, rest {_CUTS}"), "contexts")
    contexts = placed.filter("bytes is not null").drop("first", "rest")
    decided = placed.filter("bytes is null").select("key", "span", "doc_id", "rid", "start", "first", "rest").unionByName(_decided(contexts, length, keep_first, group))
    decided = written(decided.select("key", "span", F.struct("doc_id", "rid", "start").alias("own"), "first", "rest"), "decided")
    discard(placed, spans)
    here = F.when(F.struct("doc_id", "rid", "start") == F.col("own"), F.col("first")).otherwise(F.col("rest"))
    hits = found.join(decided, ["key", "span"]).select("doc_id", "rid", "start", F.explode(here).alias("cut"))
    return hits.select("doc_id", "rid", (F.col("start") + F.col("cut.b")).alias("begin"), (F.col("start") + F.col("cut.e")).alias("finish"))


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    d = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 62))).alias("doc_id"), text_or_empty(text_col).alias("text"), F.col(id_col).cast("long").alias("id"))
    return d.withColumn("rid", F.xxhash64("doc_id", "text"))


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, keep_first: bool = False, gram: int = 0, group: int = GROUP) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the remaining bytes).

    Removes every byte that is covered by a string of ``length`` UTF-8 bytes which also starts anywhere else, in the same
    document too; with ``keep_first``, only what has an earlier match in order of id, then position. Strings are judged on
    the input, overlaps count, matches never cross documents, and removed ranges that touch are one span.

    Null text is empty. Rows that repeat an id with other text are documents of their own. Rows that repeat id and text
    are copies of each other: all their strings are repeated, and without an order between them they are all cut alike.
    An empty table gives no rows; extra columns are not read.
    """
    d = _prepared(docs, id_col, text_col)
    found = repeated_ranges(d.select("doc_id", "rid", "text"), length, keep_first, gram, group)
    cover = found.groupBy("doc_id", "rid").agg(F.array_sort(F.collect_set(F.struct("begin", "finish"))).alias("cover"))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc, text, cover in zip(*(c.to_pylist() for c in batch.columns)):
                data, out, at, spans, removed, end = text.encode(), [], 0, 0, 0, -1
                for x in cover or ():
                    if x["begin"] > end:
                        spans += 1
                        out.append(data[at : x["begin"]])
                    if x["finish"] > end:
                        removed += x["finish"] - max(end, x["begin"])
                        at = end = x["finish"]
                kept = b"".join([*out, data[at:]])
                rows.append((doc, len(data), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    both = d.join(cover, ["doc_id", "rid"], "left").select("id", "text", "cover")
    return both.mapInArrow(strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
