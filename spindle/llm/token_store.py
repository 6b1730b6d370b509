"""Token-id output: one wavelet matrix per shard, in one compressed file with its documents' ids and lengths."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, text_or_empty, written
from .encode import encoder, tokenizer_path

#: Ids in a shard, but for a longer single document.
SHARD_IDS = 1 << 21

MAGIC = b"WVM2"
_HEAD = struct.Struct("<4sBQQ")
#: Bits of a block, between two entries of the rank directory, and blocks of a chunk, which is compressed on its own.
_BITS, _CHUNK = 512, 256


class _Plane:
    """One bit plane: compressed chunks, opened when they are asked for, and the number of ones before each block."""

    def __init__(self, directory: np.ndarray, chunks: list[bytes]):
        self.directory, self._packed, self._open = directory, chunks, {}

    @classmethod
    def of(cls, bit: np.ndarray) -> _Plane:
        data = np.packbits(bit, bitorder="little")
        data = np.pad(data, (0, (len(bit) // _BITS + 1) * (_BITS // 8) - len(data))).reshape(-1, _BITS // 8)
        ones = np.bitwise_count(data.view(np.uint64)).sum(1, dtype=np.int64)
        squeeze = zstandard.ZstdCompressor(level=1)
        return cls((np.cumsum(ones) - ones).astype("<u4"), [squeeze.compress(data[k : k + _CHUNK].tobytes()) for k in range(0, len(data), _CHUNK)])

    def pack(self) -> list[bytes]:
        return [zstandard.ZstdCompressor(level=1).compress(self.directory.tobytes()), *self._packed]

    @classmethod
    def unpack(cls, blocks: list[bytes]) -> _Plane:
        return cls(np.frombuffer(zstandard.ZstdDecompressor().decompress(blocks[0]), "<u4"), blocks[1:])

    def _chunk(self, k: int) -> np.ndarray:
        if k not in self._open:
            self._open[k] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self._packed[k]), np.uint8).reshape(-1, _BITS // 8)
        return self._open[k]

    def bits(self, n: int) -> np.ndarray:
        data = np.concatenate([self._chunk(k) for k in range(len(self._packed))])
        return np.unpackbits(data.ravel(), count=n, bitorder="little").view(bool)

    def blocks(self, at: np.ndarray) -> np.ndarray:
        """The bits of the blocks ``at``, a row each; only their chunks are opened."""
        out = np.empty((len(at), _BITS // 8), np.uint8)
        chunk = at // _CHUNK
        for k in np.unique(chunk).tolist():
            own = chunk == k
            out[own] = self._chunk(k)[at[own] % _CHUNK]
        return np.unpackbits(out, axis=1, bitorder="little")

    def bit(self, i: np.ndarray) -> np.ndarray:
        return self.blocks(i // _BITS)[np.arange(len(i)), i % _BITS].astype(bool)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place: the directory's entry, and the rest of a block."""
        out = self.directory[i // _BITS].astype(np.int64)
        for k in range(0, len(i), 4096):  # bounds the unpacked blocks
            part = i[k : k + 4096]
            out[k : k + 4096] += (self.blocks(part // _BITS) * (np.arange(_BITS) < (part % _BITS)[:, None])).sum(1, dtype=np.int64)
        return out

    def place(self, one: bool, k: np.ndarray) -> np.ndarray:
        """The place of the k-th one or zero: its block by the directory, then within the block."""
        before = self.directory.astype(np.int64) if one else np.arange(len(self.directory)) * _BITS - self.directory
        block = np.searchsorted(before, k, "right") - 1
        out = np.empty(len(k), np.int64)
        for a in range(0, len(k), 4096):
            own = block[a : a + 4096]
            count = np.cumsum(self.blocks(own) == one, axis=1)
            out[a : a + 4096] = own * _BITS + (count == (k[a : a + 4096] - before[own] + 1)[:, None]).argmax(1)
        return out


class WaveletMatrix:
    """Bit planes from the top bit down; each level deals the order into zeros, then ones, and keeps either's order.

    Queries take arrays: places or counts are answered together, level by level.
    """

    def __init__(self, n: int, planes: list[_Plane], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        a = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes, zeros = [], []
        for level in range(width - 1, -1, -1):
            bit = (a & a.dtype.type(1 << level)) != 0
            planes.append(_Plane.of(bit))
            low = np.compress(~bit, a)
            zeros.append(len(low))
            a = np.concatenate([low, np.compress(bit, a)])
        return cls(len(ids), planes, zeros)

    def decode(self) -> np.ndarray:
        """All ids in order: from the lowest plane up, each level undoes its deal."""
        a = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            bit = self.planes[level].bits(self.n)
            up = np.empty_like(a)
            z = self.zeros[level]
            up[np.flatnonzero(~bit)] = a[:z]
            up[np.flatnonzero(bit)] = a[z:] | a.dtype.type(1 << (len(self.planes) - 1 - level))
            a = up
        return a

    def access(self, i: np.ndarray) -> np.ndarray:
        """The ids at the places i."""
        i = np.asarray(i, np.int64)
        value = np.zeros(len(i), np.int64)
        for plane, z in zip(self.planes, self.zeros):
            bit, ones = plane.bit(i), plane.ones(i)
            i = np.where(bit, z + ones, i - ones)
            value = value * 2 + bit
        return value

    def _steps(self, token: int) -> list[bool]:
        return [bool(token >> k & 1) for k in range(len(self.zeros) - 1, -1, -1)]

    def _down(self, token: int, i: np.ndarray) -> np.ndarray:
        for plane, z, one in zip(self.planes, self.zeros, self._steps(token)):
            ones = plane.ones(i)
            i = z + ones if one else i - ones
        return i

    def rank(self, token: int, end: np.ndarray) -> np.ndarray:
        """How often ``token`` stands before each place of ``end``."""
        end = np.asarray(end, np.int64)
        if token >> len(self.zeros):
            return np.zeros(len(end), np.int64)
        at = self._down(token, np.append(end, 0))
        return at[:-1] - at[-1]

    def count(self, token: int) -> int:
        return int(self.rank(token, np.array([self.n]))[0])

    def select(self, token: int, k: np.ndarray) -> np.ndarray:
        """The places of the k-th ``token``, from 0, for each k."""
        k = np.asarray(k, np.int64)
        if len(k) and not (0 <= k.min() and k.max() < self.count(token)):
            raise IndexError("there are not so many")
        i = self._down(token, np.zeros(1, np.int64)) + k
        for plane, z, one in reversed(list(zip(self.planes, self.zeros, self._steps(token)))):
            i = plane.place(one, i - z if one else i)
        return i

    def occurrences(self, token: int) -> np.ndarray:
        return self.select(token, np.arange(self.count(token)))


def pack(doc_ids: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A shard's file: head, sizes of the blocks, then document ids, which of them are null, lengths, zero counts, and of
    each plane its rank directory and chunks. Each block is compressed, so a query opens the chunks it needs and no more."""
    squeeze = zstandard.ZstdCompressor(level=1)
    w = WaveletMatrix.build(ids)
    null = np.array(doc_ids.is_null())
    named = np.array(doc_ids.fill_null(0), "<i8")
    blocks = [squeeze.compress(x.tobytes()) for x in (named, np.packbits(null), lengths.astype("<i8"), np.array(w.zeros, "<i8"))]
    blocks += [b for plane in w.planes for b in plane.pack()]
    return _HEAD.pack(MAGIC, len(w.planes), len(doc_ids), len(ids)) + np.array([len(blocks), *map(len, blocks)], "<u4").tobytes() + b"".join(blocks)


def unpack(blob: bytes) -> tuple[pa.Array, np.ndarray, WaveletMatrix]:
    magic, width, n_docs, n = _HEAD.unpack_from(blob)
    if magic != MAGIC:
        raise ValueError("not a shard file")
    (count,) = np.frombuffer(blob, "<u4", 1, _HEAD.size).tolist()
    sizes = np.frombuffer(blob, "<u4", count, _HEAD.size + 4).astype(np.int64)
    ends = _HEAD.size + 4 + 4 * count + np.cumsum(sizes)
    blocks = [blob[b - s : b] for b, s in zip(ends.tolist(), sizes.tolist())]
    opened = zstandard.ZstdDecompressor()
    named, null, lengths, zeros = (opened.decompress(b) for b in blocks[:4])
    per = (count - 4) // width
    planes = [_Plane.unpack(blocks[4 + k * per : 4 + (k + 1) * per]) for k in range(width)]
    doc_ids = pa.array(np.frombuffer(named, "<i8"), pa.int64(), mask=np.unpackbits(np.frombuffer(null, np.uint8), count=n_docs).view(bool))
    return doc_ids, np.frombuffer(lengths, "<i8"), WaveletMatrix(n, planes, np.frombuffer(zeros, "<i8").tolist())


def in_id_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text`` in ranges of ids, each sorted; as many ranges as the input has partitions.

    Rows of one id are in order of a hash of their text, so that a very frequent id can be split.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    d = d.withColumn("hash", F.xxhash64("text"))
    return d.repartitionByRange(max(1, d.rdd.getNumPartitions()), "doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text").drop("hash")


def write_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, tokenizer: str = "", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encodes whole texts, ends each with ``end_id`` and writes shards in ascending id order; returns the shards' table.

    A shard is one row ``part, seq, n_docs, n_ids, blob`` of a Parquet table in the shared folder: Spark's commit
    protocol makes each file whole or absent, on any file system, when tasks are lost or run twice. ``blob`` is the file
    format of :func:`pack`. A worker holds one shard at a time. Texts, not ids, are shuffled: compressed, they are smaller.

    Null text is an empty document and has the end id only; null ids come first and are read back as null; rows that
    repeat are documents of their own. An empty table has no shards; extra columns are not read.
    """
    path = tokenizer or tokenizer_path()
    end = np.array([end_id], np.uint32)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, names, held, size = TaskContext.get().partitionId(), 0, [], [], 0

        def shard() -> pa.RecordBatch:
            lengths = np.array([len(x) + 1 for x in held], np.int64)
            ids = np.concatenate([x for own in held for x in (own, end)])
            blob = pack(pa.array(names, pa.int64()), lengths, ids)
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_docs": [len(held)], "n_ids": [len(ids)], "blob": [blob]})

        encoded = encoder(path)
        for batch in slices(batches):
            for i, ids in zip(batch.column(0).to_pylist(), encoded.many(batch.column(1))):
                if held and size + len(ids) >= shard_ids:
                    yield shard()
                    seq, names, held, size = seq + 1, [], [], 0
                names.append(i)
                held.append(ids)
                size += len(ids) + 1
        if held:
            yield shard()

    rows = in_id_order(docs, id_col, text_col).mapInArrow(encode, "part int, seq int, n_docs long, n_ids long, blob binary")
    return written(rows, "shards")


def read_shards(shards: DataFrame, end_id: int = 0) -> DataFrame:
    """Per document, from the files alone: ``doc_id, start, n_tokens, ids_crc32, first_id, end_ids``.

    The checksum is over the decoded ids. ``first_id`` is a document's first id, by access; ``end_ids`` counts ``end_id``
    in it, the one that ends it included, by ranks at its bounds.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            (part,), (seq,) = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            doc_ids, lengths, w = unpack(batch.column(2)[0].as_py())
            raw, ends = memoryview(w.decode().astype("<u4").tobytes()), np.cumsum(lengths)
            begins = ends - lengths
            crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
            ranks = np.diff(np.append(w.rank(end_id, begins), w.count(end_id)))
            n = len(doc_ids)
            columns = {"part": pa.array([part] * n, pa.int32()), "seq": pa.array([seq] * n, pa.int32()), "doc_id": doc_ids, "at": begins, "n_tokens": lengths, "ids_crc32": pa.array(crcs, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | {"first_id": w.access(begins), "end_ids": ranks})

    rows = shards.select("part", "seq", "blob").mapInArrow(decode, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long, first_id long, end_ids long")
    rows = rows.join(_bases(shards), ["part", "seq"])
    return rows.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "first_id", "end_ids")


def _bases(shards: DataFrame) -> DataFrame:
    """Ids before each shard, ``part, seq, base``: those of earlier parts, a row each, and those of earlier shards of its part."""
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_base"))
    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("part", "seq", F.coalesce(F.sum("n_ids").over(in_part), F.lit(0)).alias("seq_base")).join(parts, "part")
    return bases.select("part", "seq", (F.col("part_base") + F.col("seq_base")).alias("base"))


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """Where an id stands, ``doc_id, place`` within the document: selected in each shard, which isn't decoded for it."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            doc_ids, lengths, w = unpack(batch.column(0)[0].as_py())
            at, ends = w.occurrences(token), np.cumsum(lengths)
            owner = np.searchsorted(ends, at, "right")
            yield pa.RecordBatch.from_pydict({"doc_id": doc_ids.take(pa.array(owner)), "place": at - (ends - lengths)[owner]})

    return shards.select("blob").mapInArrow(find, "doc_id long, place long")
