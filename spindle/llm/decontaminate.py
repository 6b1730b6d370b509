"""Benchmark decontamination: the rarest word pairs of a test item join passages to it, Smith-Waterman alignment scores them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_or_empty
from .hashing import BASE, U, grams, mixed, words

#: Score of equal words, other words, and a gap; an alignment counts from this share of the item's own score.
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE = 0.5
#: Items, and characters of items, that are compared with the corpus at a time; a larger benchmark takes several blocks.
BLOCK_ITEMS, BLOCK_CHARS = 50_000, 32_000_000


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word-hash arrays: score, and begin and end of the aligned words of the passage.

    Row by row over the item: with a linear gap, the best way along a row is a running maximum.
    """
    n = len(passage)
    ramp = np.arange(n + 1) * -GAP
    score, origin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for w in item:
        step = np.where(passage == w, MATCH, MISMATCH)
        down = score + GAP
        diagonal = np.concatenate([[0], score[:-1] + step])
        s = np.maximum(np.maximum(diagonal, down), 0)
        o = np.where(s == 0, np.arange(n + 1), np.where(diagonal >= down, np.concatenate([[0], origin[:-1]]), origin))
        lifted = s + ramp
        along = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == along, np.arange(n + 1), 0))
        score, origin = along - ramp, o[source]
        at = int(score.argmax())
        if score[at] > best[0]:
            best = (int(score[at]), int(origin[at]), at)
    return best


class Items:
    """A block of test items: ids, words, and seeds, one for each place of an item that has one."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids = ids
        self.words = [words(t) for t in texts]
        self.single = any(len(w) == 1 for w in self.words)
        self.seeds = [_pairs_of(w) for w in self.words]
        self.distinct = np.unique(np.concatenate([np.zeros(0, U), *self.seeds]))


class RareSeeds:
    """The rarest seeds of each item in order of their digests, each with its item.

    A passage that scores enough holds the seeds of at least k of an item's m places, so it holds one of any m - k + 1
    of them: those that are rarest in the corpus are looked for, and no others. Seeds that it holds nowhere are left out.
    """

    def __init__(self, items: Items, counts: np.ndarray, least_score: float):
        seed, item = [np.zeros(0, U)], [np.zeros(0, np.int64)]
        for i, (w, own) in enumerate(zip(items.words, items.seeds)):
            n = counts[np.searchsorted(items.distinct, own)]
            rarest = np.lexsort((own, n))[: len(own) - least_hits(len(w), least_score) + 1] if len(own) else []
            chosen = np.unique(own[rarest][n[rarest] > 0])
            seed.append(chosen)
            item.append(np.full(len(chosen), i))
        seed, item = np.concatenate(seed), np.concatenate(item)
        order = np.argsort(seed, kind="stable")
        self.seed, self.item = seed[order], item[order]
        self.finder = _Finder(np.unique(self.seed))


def _pairs_of(w: np.ndarray) -> np.ndarray:
    """The seeds of an item: neighbouring words; of three words, the outer two as well; of one, the word."""
    if len(w) == 1:
        return grams(w, 1)
    return np.concatenate([grams(w, 2), grams(w[::2], 2)]) if len(w) == 3 else grams(w, 2)


def least_hits(n: int, least_score: float) -> int:
    """How many seeds of an item of n words at least stand in a passage that scores ``least_score``.

    Let m words match, with score 2m - e, and T = 2 * least_score * n. Of the m - 1 steps from a match to the next, all are
    seeds but those x that skip words of the item and those y that skip two words of the passage or more. As x <= n - m and
    x + 2y <= e <= 2m - T, at least m - 1 - x - y >= (2T - n) / 3 - 1 are.
    """
    return max(1, int(np.ceil((4 * least_score - 1) * n / 3 - 1 - 1e-9)))


class _Finder:
    """A set of digests with a bitmap before it, which turns away nearly all others in one look."""

    def __init__(self, sorted_digests: np.ndarray):
        self.digests = sorted_digests
        self.bits = max(16, int(len(sorted_digests)).bit_length() + 5)
        self.map = np.zeros(1 << self.bits, bool)
        self.map[(sorted_digests >> U(64 - self.bits)).astype(np.int64)] = True

    def places(self, g: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.map[(g >> U(64 - self.bits)).astype(np.int64)])
        if not len(maybe):
            return maybe
        at = np.minimum(np.searchsorted(self.digests, g[maybe]), len(self.digests) - 1)
        return maybe[self.digests[at] == g[maybe]]


def _grams_of(text_words: np.ndarray, single: bool) -> list[np.ndarray]:
    """What of a text may be a seed: words next to each other, with one word between, and single ones if an item is one."""
    return [grams(text_words, 2), mixed(text_words[:-2] * BASE + text_words[2:]), *([grams(text_words, 1)] if single else [])]


def align(text_words: np.ndarray, items: Items, rare: RareSeeds, least_score: float) -> list[tuple]:
    """Hits of one document: ``(item place, score share, begin, end)`` in words.

    The rare seeds in the text are joined to their items; only what lies about one of an item's rare seeds is aligned.
    """
    if not len(rare.seed):
        return []
    runs = _grams_of(text_words, items.single)
    found = [rare.finder.places(g) for g in runs]
    g, where = np.concatenate([g[at] for g, at in zip(runs, found)]), np.concatenate(found)
    if not len(g):
        return []
    lo, hi = np.searchsorted(rare.seed, g, "left"), np.searchsorted(rare.seed, g, "right")
    times = hi - lo
    which = rare.item[np.repeat(lo, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
    at = np.repeat(where, times)
    order = np.lexsort((at, which))
    which, at = which[order], at[order]
    bounds = np.flatnonzero(np.diff(which, prepend=-1))
    out = []
    for first, last in zip(bounds.tolist(), [*bounds[1:].tolist(), len(which)]):
        i = int(which[first])
        w = items.words[i]
        span = int(np.ceil((3 - 2 * least_score) * len(w)))  # the longest passage that scores enough
        begin, end = np.maximum(at[first:last] - span, 0), at[first:last] + span + 2
        cuts = np.flatnonzero(begin[1:] > end[:-1]) + 1
        best = (0, 0, 0)
        for a, b in zip(begin[np.append(0, cuts)].tolist(), end[np.append(cuts - 1, len(end) - 1)].tolist()):
            passage = text_words[a:b]
            if np.isin(w, passage).sum() < least_score * len(w) or _held(items.seeds[i], passage, items.single) < least_hits(len(w), least_score):
                continue
            s, x, y = smith_waterman(w, passage)
            best = max(best, (s, a + x, a + y))
        if best[0] >= least_score * MATCH * len(w):
            out.append((i, best[0] / (MATCH * len(w)), best[1], best[2]))
    return out


def _held(seeds: np.ndarray, passage: np.ndarray, single: bool) -> int:
    """Places of an item whose seed a passage holds."""
    return int(np.isin(seeds, np.concatenate(_grams_of(passage, single))).sum())


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least_score: float = LEAST_SCORE, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row per document and test item that it holds: ``doc_id, item_id, score, begin, end``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. An item's seeds are its pairs of neighbouring words, which may
    stand in a document next to each other or with one word between. One pass counts them in all documents. A passage
    that scores ``least_score`` holds a certain number of an item's seeds at least (:func:`least_hits`), and so one of its
    rarest (:class:`RareSeeds`): these join passages to items in the second pass, and what lies about them is
    aligned with the item. ``score`` is the alignment's share of the item's own score, so edited and partly rewritten
    copies count from ``least_score`` on, and from 0.5 on none that the alignment accepts is passed over. The items and
    their rare seeds go to every worker, and only counts of seeds are shuffled.

    The test items are a stated query set: blocks of ``block_items`` of them are compared with all documents, one block
    after another, so what goes to the workers is bounded. Items of one or two words count where all their words stand as
    a seed does. An alignment takes time in the item's length times the passage's. Null texts are empty; null item ids are
    kept as null; rows that repeat are compared alike; with no documents or no items there are no rows; extra columns are
    not read.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    out = spark.createDataFrame([], _HIT)
    for items in _item_blocks(benchmark, item_col, item_text_col, block_items):
        find = _finder(d, items, least_score)

        def hits(batches: Iterator[pa.RecordBatch], find=find, ids=items.ids) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                rows = [(doc, ids[i], score, a, b) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for i, score, a, b in find(text)]
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], ["doc_id", "item_id", "score", "begin", "end"])

        out = out.unionByName(d.mapInArrow(hits, _HIT))
    return out


_HIT = "doc_id long, item_id long, score double, begin long, end long"


def _item_blocks(benchmark: DataFrame, item_col: str, item_text_col: str, block_items: int) -> Iterator[Items]:
    """The test items in blocks of bounded size, those with a seed."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("item_id"), text_or_empty(item_text_col).alias("text"))
    n, chars = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    n = max(-(-n // block_items), -(-chars // BLOCK_CHARS), 1)
    blocks = [rows.filter(F.pmod(F.xxhash64("text", "item_id"), F.lit(n)) == k) for k in range(n)] if n > 1 else [rows]
    for block in blocks:
        held = block.collect()
        items = Items([r.item_id for r in held], [r.text for r in held])
        if len(items.distinct):
            yield items


def seed_counts(d: DataFrame, items: Items) -> np.ndarray:
    """How often each of the block's distinct seeds stands in the texts of ``d``, summed per task and then by seed."""
    sent = d.sparkSession.sparkContext.broadcast((items.distinct, items.single))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct, single = sent.value
        finder, n = _Finder(distinct), np.zeros(len(distinct), np.int64)
        for batch in slices(batches):
            for text in batch.column(0):
                for g in _grams_of(words(text.as_py()), single):
                    n += np.bincount(np.searchsorted(distinct, g[finder.places(g)]), minlength=len(n)) if len(g) else 0
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["seed", "n"])

    counts = np.zeros(len(items.distinct), np.int64)
    for r in d.select("text").mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).collect():  # a row a seed of the block
        counts[r.seed] = r.n
    return counts


def _finder(d: DataFrame, items: Items, least_score: float) -> Callable[[str], list[tuple]]:
    """The search of one text, for use in tasks."""
    sc = d.sparkSession.sparkContext
    sent_items, sent_rare = sc.broadcast(items), sc.broadcast(RareSeeds(items, seed_counts(d, items), least_score))
    return lambda text: align(words(text), sent_items.value, sent_rare.value, least_score)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least_score: float = LEAST_SCORE, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all columns: each is judged where it lies, and no row is joined.

    Null and empty texts hold nothing and stay; rows that repeat are judged alike, ids don't count; without items or rows
    the table comes back as it is. Columns of any name are kept. See :func:`find_leaks`.
    """
    d, at = docs.select(text_or_empty(text_col).alias("text")), docs.columns.index(text_col)
    for items in _item_blocks(benchmark, item_col, item_text_col, block_items):
        find = _finder(d, items, least_score)

        def clean(batches: Iterator[pa.RecordBatch], find=find) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                yield batch.filter(pa.array([not find(t or "") for t in batch.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
