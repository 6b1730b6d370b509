"""Token counts from flat token files that have no index: a scan for the separator, stitched by a prefix scan."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, text_or_empty, written
from .encode import encoder, tokenizer_path

#: Ids in a block; blocks end anywhere, also within a document.
BLOCK_IDS = 1 << 20


def flat_dtype(tokenizer: str = "", end_id: int = 0) -> str:
    """Little-endian uint16 where vocabulary and separator fit, else uint32."""
    return "<u2" if max(encoder(tokenizer or tokenizer_path()).largest, end_id) < 1 << 16 else "<u4"


def write_flat(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = 50256, tokenizer: str = "", block_ids: int = BLOCK_IDS) -> DataFrame:
    """Flat files of little-endian ids (:func:`flat_dtype`), each document ended by ``end_id``, as rows ``part, block, data, doc_ids``.

    A file holds the documents of one input partition as they come; nothing is shuffled.

    Special tokens' strings in a text are ordinary text, so ``end_id`` is a separator and nothing else; an id that text
    can give is refused. ``data`` is cut
    every ``block_ids`` ids, whatever lies there. ``doc_ids`` lists which documents follow each other in the part; it
    says nothing of where they begin. Null text is an empty document.
    """
    path = tokenizer or tokenizer_path()
    if end_id < 0 or encoder(path).is_produced(end_id):
        raise ValueError(f"{end_id} is no separator: texts hold it")
    dtype = flat_dtype(path, end_id)
    wide, end = np.dtype(dtype).itemsize, np.array([end_id], dtype).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, data, names = TaskContext.get().partitionId(), 0, bytearray(), []
        row = lambda b: pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "data": [bytes(b)], "doc_ids": pa.array([names], pa.list_(pa.int64()))})
        encoded = encoder(path)
        for batch in slices(batches):
            names += batch.column(0).to_pylist()
            for text in batch.column(1):
                data += np.frombuffer(encoded(text.as_py(), True), "<u4").astype(dtype).tobytes()
                data += end
            while len(data) >= wide * block_ids:
                yield row(data[: wide * block_ids])
                del data[: wide * block_ids]
                block, names = block + 1, []
        if data or names:
            yield row(data)

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return written(d.mapInArrow(encode, "part int, block int, data binary, doc_ids array<long>"), "flat")


def separator_scan(blocks: DataFrame, end_id: int = 50256, dtype: str = "<u2") -> DataFrame:
    """Documents of flat token files: ``part, ordinal, start, n_tokens, closed``.

    ``blocks`` has ``part, block, data``: the bytes of file ``part``, cut at any id. Each block is searched on its own, as
    a vector. A prefix scan over one row per block then gives each the ids and separators before it and the end of the
    document before it, which stitches documents that span blocks. ``start`` counts ids of the file; ``n_tokens`` leaves
    out the separator; a last document without a separator has ``closed`` false. A file without ids has no document;
    null or empty data counts as no ids.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4):
            for part, block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids = np.frombuffer(data.as_py() or b"", dtype)
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "n": [len(ids)], "seps": [np.flatnonzero(ids == end_id)]})

    found = written(blocks.select("part", "block", "data").mapInArrow(scan, "part int, block int, n long, seps array<long>"), "separators")
    order = Window.partitionBy("part").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sums = found.select("part", "block", "n", F.size("seps").cast("long").alias("k"), F.array_max("seps").alias("last"))
    sums = sums.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    sums = sums.select(
        "part", "block", "n", "base",
        F.coalesce(F.sum("k").over(before), F.lit(0)).alias("ordinal0"),
        F.coalesce(F.last(F.col("base") + F.col("last"), ignorenulls=True).over(before) + 1, F.lit(0)).alias("open_from"),
        F.lead("block").over(order).isNull().alias("final"),
    )
    b = found.select("part", "block", "seps").join(sums, ["part", "block"])
    ends = F.transform("seps", lambda s: s + F.col("base"))
    cut = F.col("ends")
    rest = F.when(F.col("final") & (F.coalesce(F.array_max(cut) + 1, F.col("open_from")) < F.col("base") + F.col("n")), F.array(F.col("base") + F.col("n")))
    b = b.withColumn("ends", ends).withColumn("rest", F.coalesce(rest, F.array().cast("array<long>")))
    b = b.withColumn("all", F.concat("ends", "rest"))
    docs = F.transform("all", lambda e, k: F.struct((F.col("ordinal0") + k).alias("ordinal"), F.when(k == 0, F.col("open_from")).otherwise(F.get("all", k - 1) + 1).alias("start"), e.alias("end"), (k < F.size("ends")).alias("closed")))
    return b.select("part", F.explode(docs).alias("d")).select("part", "d.ordinal", "d.start", (F.col("d.end") - F.col("d.start")).alias("n_tokens"), "d.closed")


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = 50256, tokenizer: str = "", block_ids: int = BLOCK_IDS) -> DataFrame:
    """Writes ``docs`` as flat files and counts them by :func:`separator_scan`: ``doc_id, n_tokens``, without separators.

    Rows that repeat are documents of their own, null ids stay null; an empty table gives no rows; extra columns are not read. The files name
    no documents: those of a file are listed beside it in order, and the scan's ordinals find them there.
    """
    blocks = write_flat(docs, id_col, text_col, end_id, tokenizer, block_ids)
    found = separator_scan(blocks, end_id, flat_dtype(tokenizer, end_id))
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    names = blocks.select("part", "doc_ids", F.coalesce(F.sum(F.size("doc_ids")).over(before), F.lit(0)).cast("long").alias("first"))
    names = names.select("part", "first", F.posexplode("doc_ids").alias("k", "doc_id")).select("part", (F.col("first") + F.col("k")).alias("ordinal"), "doc_id")
    return found.join(names, ["part", "ordinal"]).select("doc_id", "n_tokens")
