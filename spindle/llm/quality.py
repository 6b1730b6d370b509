"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text."""

from __future__ import annotations

import re
import zlib
from collections.abc import Container, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, slices, text_or_empty, written

#: Hashed features; and the most labelled rows and features of rows that the fit takes, the documented bounds of its sample.
BUCKETS, MOST_ROWS, MOST_FEATURES = 1 << 20, 16_000, 12_000_000
#: Words that a task remembers, none longer than LONGEST: at most some 250 bytes each.
REMEMBERED, LONGEST = 120_000, 64

_CORE = re.compile(r"[^\W\d_]+")
_STEM = 4


def grades(quality: str = "quality", toxic: str = "toxic") -> Column:
    """The rating: 0 for toxic text, 1 for poor text, 2 for good text; null where quality is not rated."""
    return F.when(F.col(toxic) > 0, 0).when(F.col(quality) > 0, 2).when(F.col(quality) <= 0, 1)


def _shape(word: str) -> str:
    """``mark`` for a word that ends in a symbol which ends no sentence, or twice in the same mark; ``caps``; or ``plain``."""
    last = word[-1]
    if not last.isalnum() and (last not in ".,;:!?)\"'" or word[-2:-1] == last):
        return "mark"
    return "caps" if len(word) > 1 and word.isupper() else "plain"


def _named(token: str) -> tuple[str, ...]:
    """Its shape, and the names of a word: its letters, lower-cased, and their first few."""
    core = "".join(_CORE.findall(token.lower()))
    return (_shape(token), core, "^" + core[:_STEM]) if core else (_shape(token),)


def _shares(tokens: list[str], odd: dict[str, int]) -> list[str]:
    """Names of the shares of odd words and repeats, in steps."""
    n, kinds = len(tokens), len(set(tokens))
    shares = (("mark", odd["mark"] / n), ("caps", odd["caps"] / n), ("repeat", sum(map(str.__eq__, tokens, tokens[1:])) / n), ("few", 1 - kinds / n if n >= 20 else 0))
    return [f"§{name}{step}" for name, share in shares for step in (0.02, 0.05, 0.1, 0.2, 0.4, 0.7) if share >= step]


def features(text: str, seen: dict[str, tuple], keep: Container[int] | None = None) -> set[int]:
    """Hashed features of a text: its distinct words and stems, and shares of odd words and repeats; those in ``keep`` only.

    ``seen`` remembers what a word gives, for one ``keep``.
    """
    tokens = text.split()
    out: set[int] = set()
    odd = {"mark": 0, "caps": 0, "plain": 0}
    for t in tokens:
        got = seen.get(t)
        if got is None:
            shape, *names = _named(t)
            got = (shape, tuple(b for b in map(_bucket, names) if keep is None or b in keep))
            if len(seen) < REMEMBERED and len(t) <= LONGEST:
                seen[t] = got
        odd[got[0]] += 1
        if got[1]:
            out.update(got[1])
    rest = map(_bucket, _shares(tokens, odd) if tokens else ["§empty"])
    out.update(b for b in rest if keep is None or b in keep)
    return out


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode()) & (BUCKETS - 1)


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade <= k) = logistic(thresholds[k] - w.x): one weight for each feature, shared by all thresholds."""

    weights: dict[int, float]
    thresholds: tuple[float, ...]

    def score(self, text: str, seen: dict) -> float:
        w = self.weights
        return sum(w[b] for b in sorted(features(text, seen, w)))


def fit_arrays(rows: list[np.ndarray], grade: np.ndarray, steps: int = 300, rate: float = 0.5, l1: float = 1e-4, least: int = 4, least_z: float = 6.0, most: float = 0.0) -> OrdinalModel:
    """Full-batch proximal AdaGrad on the cumulative-link loss, with a small L1 penalty.

    Only features take part whose share of rows differs between a grade and the others by ``least_z`` standard errors or
    more, in at least ``least`` rows: chance alone hardly does that, even among a million buckets. Thresholds stay in
    order, as their gaps are exponentials. Weights are at most ``most``, 0 unless told otherwise: features tell faults, so
    a short text without any gets the best score, whatever common words it lacks. On one held-out half of the ratings the
    loss is somewhat less without the bound on weights; the bound stays for short texts (figures in the README).
    """
    grade = np.asarray(grade, np.int64)
    kinds = np.unique(grade)
    flat = np.concatenate([np.zeros(0, np.int64), *rows])
    index = np.arange(flat.max() + 1 if len(flat) else 0)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    in_all = np.bincount(flat, minlength=len(index))
    z = np.zeros(len(index))
    for k in kinds[: len(kinds) if len(kinds) > 1 else 0]:
        n_k = (grade == k).sum()
        n_rest, in_k = len(grade) - n_k, np.bincount(flat, weights=(grade == k)[doc], minlength=len(index))
        p = in_all / len(grade)
        error = np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n_k + 1 / n_rest))
        z = np.maximum(z, np.abs(in_k / n_k - (in_all - in_k) / n_rest) / error)
    often = (in_all >= least) & (z >= least_z)
    keep = often[flat]
    place = np.cumsum(often) - 1
    index, flat, doc = index[often], place[flat[keep]], doc[keep]
    if len(kinds) < 2 or not len(index):
        only = int(kinds[0]) if len(kinds) else 2
        return OrdinalModel({}, tuple(-30.0 if k < only else 30.0 for k in range(max(2, only))))
    top = max(2, int(kinds.max()))
    level = np.searchsorted(kinds, grade)  # grades without rows have no threshold to learn
    n, cuts = len(grade), len(kinds) - 1
    weight = np.full(n, 1 / n)
    w, first = np.zeros(len(index)), np.zeros(1)
    gaps = np.zeros(cuts - 1)
    sums = [np.full_like(x, 1e-6) for x in (w, first, gaps)]
    logistic = lambda z: 0.5 * (1 + np.tanh(z / 2))
    for _ in range(steps):
        theta = first[0] + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        s = np.bincount(doc, weights=w[flat], minlength=n)
        upper = np.where(level < cuts, logistic(np.append(theta, 0)[np.minimum(level, cuts)] - s), 1.0)
        lower = np.where(level > 0, logistic(theta[np.maximum(level - 1, 0)] - s), 0.0)
        p = np.maximum(upper - lower, 1e-9)
        du, dl = np.where(level < cuts, upper * (1 - upper), 0) / p, np.where(level > 0, lower * (1 - lower), 0) / p
        ds = weight * (du - dl)  # slope of the loss by the score
        g = np.bincount(flat, weights=ds[doc], minlength=len(index))
        dtheta = np.zeros(cuts)
        np.add.at(dtheta, level[level < cuts], -(weight * du)[level < cuts])
        np.add.at(dtheta, level[level > 0] - 1, (weight * dl)[level > 0])
        tail = np.cumsum(dtheta[::-1])[::-1]
        for x, grad, acc in ((w, g, sums[0]), (first, tail[:1], sums[1]), (gaps, tail[1:] * np.exp(gaps), sums[2])):
            acc += grad**2
            x -= rate * grad / np.sqrt(acc)
            if x is w:
                x[:] = np.minimum(np.sign(x) * np.maximum(np.abs(x) - rate * l1 / np.sqrt(acc), 0), most)
    theta = first[0] + np.concatenate([[0], np.cumsum(np.exp(gaps))])
    # P(grade <= k) changes only at grades that occur.
    thresholds = [theta[np.searchsorted(kinds, k, "right") - 1] if kinds[0] <= k < kinds[-1] else (-30.0 if k < kinds[0] else 30.0) for k in range(top)]
    some = np.flatnonzero(w)
    return OrdinalModel(dict(zip(index[some].tolist(), w[some].tolist())), tuple(float(t) for t in thresholds))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade: Column | None = None, most_rows: int = MOST_ROWS, most_features: int = MOST_FEATURES, seed: int = 42, least: int = 4, least_z: float = 6.0) -> OrdinalModel:
    """Fits on at most ``most_rows`` rated documents, the first in order of a hash of id and seed.

    Of its rows in that order no more are taken than have ``most_features`` together. Executors hash the features and count
    which tell grades apart; the driver gets those of the bounded sample only. Rows without a rating, an id or a document don't count; null text is
    empty; of several ratings of a document each counts.
    """
    rated = labels.select(F.col(id_col).alias("__id"), (grades() if grade is None else grade).cast("int").alias("__grade")).filter("__id is not null and __grade is not null")
    place = F.xxhash64(F.lit(seed), "__id")
    sample = rated.select(place.alias("__place"), "__id", "__grade").orderBy("__place", "__id", "__grade").limit(most_rows)
    d = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("text")).join(F.broadcast(sample), "__id").select("__place", "__id", "text", "__grade")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for batch in slices(batches):
            found = pa.array([sorted(features(t, seen)) for t in batch.column(2).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pc.list_value_length(found), found], ["place", "id", "grade", "n", "features"])

    rows = written(d.mapInArrow(hashed, "place long, id long, grade int, n int, features array<int>"), "features")
    order = Window.orderBy("place", "id", "grade", "n")  # of most_rows rows
    first = rows.withColumn("before", F.sum("n").over(order) - F.col("n")).filter(F.col("before") + F.col("n") <= most_features)
    first = written(first.drop("before"), "sample")
    tell = first.sparkSession.sparkContext.broadcast(_telling(first, least, least_z))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.intersect1d(np.asarray(f.values, np.int32), tell.value, assume_unique=True) for f in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32())), *batch.columns[2:]], ["grade", "features", "place", "id", "n"])

    got = first.select("grade", "features", "place", "id", "n").mapInArrow(kept, "grade int, features array<int>, place long, id long, n int")
    got = got.orderBy("place", "id", "grade", "n").select("grade", "features").toArrow()
    discard(rows, first)
    lists = got["features"].combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.int32()))
    flat, ends = np.asarray(lists.flatten()), np.cumsum(np.asarray(pc.list_value_length(lists)), dtype=np.int64)
    return fit_arrays(np.split(flat, ends[:-1]) if len(ends) else [], got["grade"].to_numpy(), least=least, least_z=least_z)


def _telling(rows: DataFrame, least: int, least_z: float) -> np.ndarray:
    """The features whose share of rows differs between a grade and the others by ``least_z`` standard errors, counted by
    the executors: :func:`fit_arrays` uses no others, so the driver needs no others."""
    sizes = {r.grade: r["count"] for r in rows.groupBy("grade").count().collect()}
    total = sum(sizes.values())
    if len(sizes) < 2:
        return np.zeros(0, np.int32)
    counts = rows.select("grade", F.explode("features").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("all"), *[F.count_if(F.col("grade") == k).alias(f"in_{k}") for k in sizes])
    p = F.col("all") / total

    def z(k: int, n: int) -> Column:
        error = F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * (1 / n + 1 / (total - n)))
        return F.abs(F.col(f"in_{k}") / n - (F.col("all") - F.col(f"in_{k}")) / (total - n)) / error

    # A hair below the bound, which fit_arrays applies itself: rounding may differ.
    clear = F.greatest(*[z(k, n) for k, n in sizes.items()]) >= least_z - 1e-6
    return np.sort(counts.filter((F.col("all") >= least) & clear).select("f").toPandas()["f"].to_numpy(np.int32))


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row per document: ``doc_id, expected_grade, p_top, kept``; a narrow pass over whole texts.

    ``p_top`` is the probability of the top grade, the tail that selects: a document is kept from ``least`` on. Null text
    is empty; rows that repeat are scored alike; an empty table gives no rows; extra columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, seen = sent.value, {}
        theta = np.array(m.thresholds)
        for batch in slices(batches):
            s = np.array([m.score(t, seen) for t in batch.column(1).to_pylist()])
            above = 0.5 * (1 - np.tanh((theta[None, :] - s[:, None]) / 2))  # P(grade > k)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(above.sum(1)), pa.array(above[:, -1]), pa.array(above[:, -1] >= least)], ["doc_id", "expected_grade", "p_top", "kept"])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return d.mapInArrow(run, "doc_id long, expected_grade double, p_top double, kept boolean")


def select(docs: DataFrame, model: OrdinalModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the model keeps, with all columns: each is judged where it lies, and nothing is joined."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, seen = sent.value, {}
        for batch in slices(batches):
            s = np.array([m.score(t or "", seen) for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(0.5 * (1 - np.tanh((m.thresholds[-1] - s) / 2)) >= least, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
