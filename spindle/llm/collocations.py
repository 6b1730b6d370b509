"""Phrase mining level by level: only phrases whose two parts of one word less are frequent are counted; cuts are scored
from the tables of the levels."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import maybe_broadcast, slices, written
from .hashing import U, grams, mixed, prefix_sums, ranges

#: Bytes of text that a worker counts at a time. A longer text is counted in parts that overlap by the words of a phrase.
CHUNK = 4 << 20
#: Bits of the table of frequent phrases for each of them, and the most that are ever broadcast (32 MB).
BITS_EACH, MOST_BITS = 64, 1 << 28
#: Bits in one value of Spark's bitmap aggregate.
_BUCKET = 1 << 15
#: First-level parts of a language when its phrases are ranked.
SALTS = 64

#: What each byte is: 0 part of a word, 1 a blank between words, 2 the end of a piece.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?\n\x0b\x0c\r"]] = 2


class _Chunk:
    """The words of some texts, or of a part of one: ``ids`` of the pairs of language and word, the piece of each word, and
    its hash. The first ``skip`` words are only there as the beginning of phrases."""

    def __init__(self, texts: list[bytes], langs: list[str], skip: int = 0):
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        kind = _KIND[data]
        word = kind == 0
        step = np.flatnonzero(np.diff(word, prepend=False, append=False))
        self.starts, ends = step[::2], step[1::2]
        breaks = np.cumsum(kind == 2, dtype=np.int32)
        self.piece, self.last_piece = breaks[self.starts], breaks[-1] if len(breaks) else 0
        del breaks, kind
        offsets = np.zeros(len(ends) + 1, np.int32)
        np.cumsum(ends - self.starts, out=offsets[1:])
        own = pa.Array.from_buffers(pa.string(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data[word])]).dictionary_encode()
        names = sorted(set(langs))
        text_starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        of_text = np.array([names.index(x) for x in langs], np.int64)
        words_before = np.append(np.searchsorted(self.starts, text_starts), len(self.starts))
        size = max(len(own.dictionary), 1)
        self.ids, pairs = pd.factorize(np.repeat(of_text, np.diff(words_before)) * size + own.indices.to_numpy())
        self.words = own.dictionary.take(pa.array(pairs % size))
        self.langs = pa.array(names, pa.string()).take(pa.array(pairs // size))
        self.hashes = self._hashes(pairs // size, names)[self.ids]
        self.skip = skip

    def _hashes(self, lang: np.ndarray, names: list[str]) -> np.ndarray:
        words = self.words.cast(pa.large_string())
        at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        salt = np.array([int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for x in names], U)
        return mixed(ranges(prefix_sums(data), at[:-1], at[1:]) ^ salt[lang]) if len(words) else np.zeros(0, U)

    def _within(self, k: int) -> np.ndarray:
        """Where phrases of k words begin that end behind the first ``skip`` words."""
        at = np.arange(max(self.skip - k + 1, 0), max(len(self.ids) - k + 1, 0))
        return at[self.piece[at] == self.piece[at + k - 1]]

    def hashed(self, k: int, frequent: np.ndarray) -> pa.RecordBatch:
        """Counts of the phrases of k words, by hash alone, that have both their parts of k - 1 words in the bit table."""
        at, parts = self._within(k), grams(self.hashes, k - 1)
        at = at[_has(frequent, parts[at])]
        at = at[_has(frequent, parts[at + 1])]
        codes, distinct = pd.factorize(grams(self.hashes, k)[at])
        none = pa.nulls(len(distinct), pa.string())
        return pa.RecordBatch.from_arrays([none, none, pa.array(distinct.view(np.int64)), pa.array(np.bincount(codes, minlength=len(distinct)))], ["lang", "phrase", "h", "f"])

    def named(self, k: int, frequent: np.ndarray | None) -> pa.RecordBatch:
        """``lang, phrase, h, f`` of the phrases of k words, all of them or those whose hash is in the bit table."""
        at, size = self._within(k), max(len(self.words), 1)
        if frequent is not None:
            at = at[_has(frequent, grams(self.hashes, k)[at])]
        codes, most = self.ids[at], size
        for j in range(1, k):
            if most > (1 << 62) // size:
                codes, distinct = pd.factorize(codes)
                most = max(len(distinct), 1)
            codes, most = codes * size + self.ids[at + j], most * size
        codes, distinct = pd.factorize(codes)
        first = np.zeros(len(distinct), np.int64)
        first[codes[::-1]] = at[::-1]
        of = lambda j: pa.array(self.ids[first + j])
        said = [self.words.take(of(j)) for j in range(k)]
        phrase = pc.binary_join_element_wise(*said, " ") if k > 1 else said[0]
        h = grams(self.hashes, k)[first].view(np.int64)
        return pa.RecordBatch.from_arrays([self.langs.take(of(0)), phrase, pa.array(h), pa.array(np.bincount(codes, minlength=len(distinct)))], ["lang", "phrase", "h", "f"])


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return h & U(bits - 1), (h >> U(32)) & U(bits - 1)


def _has(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    one, two = _places(h, len(table) * 8)
    bit = lambda p: (table[p >> U(3)] >> (p & U(7)).astype(np.uint8)) & 1
    return (bit(one) & bit(two)).astype(bool)


def _bit_table(hashes: DataFrame) -> np.ndarray:
    """The hashes of the frequent phrases of a level as bits at two places each.

    Built by Spark's bitmap aggregate. Its size follows their number up to MOST_BITS: with more phrases than that serves,
    more of the next level pass in error, are counted, and fall below the least frequency; the result is the same.
    """
    n = hashes.count()
    bits = _BUCKET
    while bits < min(BITS_EACH * n, MOST_BITS):
        bits *= 2
    places = hashes.select(F.explode(F.array(F.col("h").bitwiseAND(bits - 1), F.shiftrightunsigned("h", 32).bitwiseAND(bits - 1))).alias("p"))
    rows = places.groupBy(F.expr("p div 32768").alias("b")).agg(F.bitmap_construct_agg(F.col("p") % _BUCKET).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for r in rows.collect():  # at most bits / _BUCKET rows of 4 KB
        out[r.b * 4096 : r.b * 4096 + 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def _chunks(batches: Iterator[pa.RecordBatch], longest: int, size: int) -> Iterator[_Chunk]:
    texts, langs, held = [], [], 0
    for batch in slices(batches):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = text.as_py().encode("utf-8", "surrogatepass").lower()
            if len(data) > size:
                yield from _parts(data, lang, longest, size)
                continue
            texts.append(data)
            langs.append(lang)
            held += len(data) + 1
            if held >= size:
                yield _Chunk(texts, langs)
                texts, langs, held = [], [], 0
    if texts:
        yield _Chunk(texts, langs)


def _parts(data: bytes, lang: str, longest: int, size: int) -> Iterator[_Chunk]:
    """A long text in parts cut between words; each begins with the last words of the piece that the cut is in."""
    kind = _KIND[np.frombuffer(data, np.uint8)]
    at = begin = skip = 0
    while at < len(data):
        end = at + size
        while end < len(data) and not (gap := kind[end : end + size]).any():
            end += size
        end = min(end + int((gap != 0).argmax()), len(data)) if end < len(data) else len(data)
        chunk = _Chunk([data[begin:end]], [lang], skip)
        yield chunk
        open_ = chunk.starts[chunk.piece == chunk.last_piece][-(longest - 1) :] if longest > 1 else chunk.starts[:0]
        at, skip = end, len(open_)
        begin = begin + int(open_[0]) if skip else end


def _pass(d: DataFrame, name: int, hash_: int, least: int, longest: int, frequent: np.ndarray | None, chunk: int) -> DataFrame:
    """``lang, phrase, h, f``, f at least ``least``, of one pass over the texts: phrases of ``name`` words, those of one word
    with the words of each language, which have no phrase; and hashes of phrases of ``hash_`` words, without a language.
    """
    sent = d.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _chunks(batches, longest, chunk):
            for found in ([c.named(name, sent.value)] if name else []) + ([c.hashed(hash_, sent.value)] if hash_ else []):
                for at in range(0, found.num_rows, 1 << 16):
                    yield found.slice(at, 1 << 16)
                if name == 1:
                    totals = pa.table(found).group_by("lang").aggregate([("f", "sum")])
                    yield pa.RecordBatch.from_arrays([totals["lang"].combine_chunks(), pa.nulls(len(totals), pa.string()), pa.array(np.zeros(len(totals), np.int64)), totals["f_sum"].combine_chunks()], ["lang", "phrase", "h", "f"])

    counted = d.mapInArrow(run, "lang string, phrase string, h long, f long").groupBy("lang", "phrase", "h").agg(F.sum("f").alias("f"))
    total = F.col("phrase").isNull() & F.col("lang").isNotNull()
    return written(counted.filter(total | (F.col("f") >= least)), f"phrases{name}")


def cut_score(a: str | Column, n: str | Column, left: str | Column, right: str | Column) -> Column:
    """floor(1000 * a * n / (left * right)), in decimals of 38 digits."""
    wide = lambda c: (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")
    up, down = F.lit(1000).cast("decimal(4,0)") * wide(a) * wide(n), wide(left) * wide(right)
    return F.call_function("div", up, down)


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 100, longest: int = 5, top: int = 2000, percent: int = 100, chunk: int = CHUNK) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts, A-Z lower-cased, split at ``. , ; : ! ?`` and U+000A to U+000D into pieces, those at spaces and tabs into words.
    ``n`` counts the words of a language and ``a`` a phrase's contiguous occurrences within pieces, overlaps included.
    Phrases of 2 to ``longest`` words with ``a >= least`` are candidates. Cutting one after its first words gives ``l`` and
    ``r``, the counts of both parts, and floor(1000 a n / (l r)); its cut of the lowest score counts, of equals the first.
    A candidate that stands inside a longer one with 100 * f >= percent * a goes. The rest are ranked by score and ``a``,
    the highest first, then by phrase in byte order.

    A pass over the texts for each length, and one more. A phrase of k words is counted only where both its parts of k - 1
    words are frequent, by a bit table of bounded size that is broadcast. Its hash is counted first, which moves little;
    the next pass counts those whose hash is frequent, with their words. These are told apart exactly, by dictionary
    numbers within a chunk of text and by their strings between chunks, so hashes decide nothing but what is counted in
    vain. Counts are combined per chunk, per task and then by phrase, so a frequent phrase is a row a task. Cuts
    are scored by joins with the tables of the levels, in decimals. As counts fall with length, a candidate that stands
    inside any longer one that makes it go also stands inside one of a word more that does, so only those are looked at.
    Ranks are taken within salted parts of a language first.

    Null text is empty, null language ``und``. Texts of any length are counted in parts that overlap. Repeated rows count as
    often as they are there; an empty table gives no rows; other columns are not read.
    """
    d = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    passes = [_pass(d, 1, 0, least, longest, None, chunk)]
    frequent = _bit_table(passes[0].filter("phrase is not null"))
    for k in range(2, longest + 1):
        passes.append(_pass(d, k - 1 if k > 2 else 0, k, least, longest, frequent, chunk))
        frequent = _bit_table(passes[-1].filter("lang is null"))
    if longest > 1:
        passes.append(_pass(d, longest, 0, least, longest, frequent, chunk))
    levels = [passes[0], *passes[2:]]
    totals = levels[0].filter("phrase is null").select("lang", F.col("f").alias("n"))
    known = reduce(DataFrame.union, levels).filter("phrase is not null").select("lang", "phrase", "f")
    rows = known.count()
    found = [x.filter("phrase is not null").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"), F.lit(k).alias("size")) for k, x in enumerate(levels[1:], 2)]
    cands = reduce(DataFrame.union, found) if found else levels[0].limit(0).select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"), F.lit(1).alias("size"))

    part = lambda start, size: F.array_join(F.slice("words", start, size), " ")
    cuts = cands.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    of = lambda name, f: maybe_broadcast(known.select("lang", F.col("phrase").alias(name), F.col("f").alias(f)), rows)
    scored = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"]).join(totals, "lang")
    scored = scored.withColumn("score", cut_score("a", "n", "l", "r")).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("c"))
    inside = cands.filter("size > 2").select("lang", F.col("a").alias("f"), F.explode(F.array(part(F.lit(1), F.col("size") - 1), part(F.lit(2), F.col("size") - 1))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("c.a")))
    kept = kept.select("lang", "phrase", *[F.col(f"c.{x}").alias(x) for x in ("a", "l", "r", "n", "score")])
    order = [F.desc("score"), F.desc("a"), "phrase"]
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order))).filter(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return kept.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
