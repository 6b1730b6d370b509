"""Exact dedup by a heavy-hitter split; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import maybe_broadcast, written

#: Most digests that the sketch tracks, and so the most that is ever broadcast: at about 100 bytes each, under 1 MB.
TRACKED = 8192


def digest_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = TRACKED) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical; of equal texts the row with the largest id stays. The SHA-256 digests are
    written once. A Misra-Gries summary (Spark's mergeable frequent-items sketch, at most ``tracked`` counters) names the
    digests that may be frequent. A second pass verifies them: it counts them exactly, combined map-side, and finds the
    row that stays. The verified winners, ``tracked`` rows at most, are broadcast, so the rows of a frequent digest are
    settled where they lie and never shuffled. All other digests, each with less than about 1/``tracked`` of the rows,
    are dealt by digest to a window.

    Null text counts as empty; a null id loses against any other and stays only if its whole group has null ids. Rows
    that repeat both id and text are one document: they all carry the same ``kept``. An empty table gives no rows; extra
    columns are not read.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("text_sha256"))
    d = written(d, "digests")
    suspects = d.select(F.expr(f"approx_top_k(text_sha256, {tracked}, {tracked})").alias("top")).select(F.explode("top.item").alias("text_sha256"))
    winners = (
        d.join(F.broadcast(suspects), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
    )
    winners = written(winners, "winners")
    split = d.join(F.broadcast(winners), "text_sha256", "left")
    same = Window.partitionBy("text_sha256")
    rest = split.filter("group_size is null").select("doc_id", "text_sha256", F.max("doc_id").over(same).alias("keep_id"), F.count(F.lit(1)).over(same).alias("group_size"))
    return (
        split.filter("group_size is not null")
        .select("doc_id", "text_sha256", "keep_id", "group_size")
        .unionByName(rest)
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = TRACKED) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see :func:`digest_groups` for the rule.

    Rows go by id and text: an id, or null, with several texts loses those only that another document stands for. Rows
    that repeat both count as one document and are all returned.
    """
    gone = digest_groups(docs, id_col, text_col, tracked).filter("not kept").select("doc_id", F.unhex("text_sha256").alias("digest")).distinct()
    gone = written(gone, "gone")
    own = F.unhex(F.sha2(F.coalesce(docs[text_col], F.lit("")), 256))
    return docs.join(maybe_broadcast(gone, gone.count()), docs[id_col].eqNullSafe(gone["doc_id"]) & (own == gone["digest"]), "left_anti")
