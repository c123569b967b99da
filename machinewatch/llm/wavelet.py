"""Token-ID output: one wavelet matrix file per shard.

A shard holds whole documents in ascending id order. Its payload has the ids'
bit-planes (most significant first, zeros moved before ones from plane to
plane), a directory of ones per 512 bits of each plane, and the documents'
lengths. From one file, without decoding it, ``access`` gives tokens at
positions, ``rank`` / ``count`` occurrences of a token and ``select`` the
place of its k-th occurrence.

Job shape: documents are range-partitioned on id and text hash and sorted within the
partitions, so each task writes consecutive shards as it reads; a worker
holds one shard. Shards close at ``shard_tokens`` ids (a longer document is a
shard of its own size). Files are written by Spark's committer (a lost
executor's tasks are done again). Places over the whole corpus come from sums
per shard, then per partition.

Defined results: null text encodes as empty (only the end id); null ids come
first; documents with equal ids are ordered by a hash of their text, then the
text; an empty table writes no shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from machinewatch.llm.common import map_rows
from machinewatch.llm.tokenizers import encoder, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
SHARD_TOKENS = 1 << 20

_MAGIC = b"WVM1"
_BLOCK = 512


class WaveletMatrix:
    """Bit-planes of a sequence of ids below ``2 ** bits`` with rank and select."""

    def __init__(self, n: int, bits: int, words: np.ndarray, ones: np.ndarray):
        self.n, self.bits, self.words, self.ones = n, bits, words, ones
        self.zeros = [n - int(ones[p, -1]) for p in range(bits)]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        n, blocks = len(ids), -(-len(ids) // _BLOCK)
        words = np.zeros((bits, blocks * 8), dtype="<u8")
        ones = np.zeros((bits, blocks + 1), dtype="<u4")
        ids = ids.astype("<u2" if bits <= 16 else "<u4")
        for plane in range(bits):
            bit = ids & ids.dtype.type(1 << (bits - 1 - plane)) != 0
            packed = np.packbits(bit, bitorder="little")
            raw = words[plane].view(np.uint8)
            raw[:len(packed)] = packed
            ones[plane, 1:] = np.cumsum(np.bitwise_count(words[plane]).reshape(-1, 8).sum(axis=1))
            ids = np.concatenate([ids[~bit], ids[bit]])
        return cls(n, bits, words, ones)

    def to_bytes(self) -> bytes:
        return struct.pack("<QB", self.n, self.bits) + self.ones.tobytes() + self.words.tobytes()

    @classmethod
    def from_bytes(cls, raw: memoryview) -> WaveletMatrix:
        n, bits = struct.unpack_from("<QB", raw)
        blocks, at = -(-n // _BLOCK), 9
        ones = np.frombuffer(raw, "<u4", bits * (blocks + 1), at).reshape(bits, blocks + 1)
        words = np.frombuffer(raw, "<u8", bits * blocks * 8, at + ones.nbytes).reshape(bits, blocks * 8)
        return cls(n, bits, words, ones)

    def _bits(self, plane: int) -> np.ndarray:
        return np.unpackbits(self.words[plane].view(np.uint8), count=self.n, bitorder="little").view(bool)

    def _rank1(self, plane: int, at: np.ndarray) -> np.ndarray:
        """Ones of a plane before each place."""
        block, word = at // _BLOCK, at // 64
        out = self.ones[plane, block].astype(np.int64)
        for step in range(8):
            full = block * 8 + step
            here = full < word
            out[here] += np.bitwise_count(self.words[plane, full[here]])
        rest = at % 64
        some = rest > 0
        mask = (np.uint64(1) << rest[some].astype(np.uint64)) - np.uint64(1)
        out[some] += np.bitwise_count(self.words[plane, word[some]] & mask)
        return out

    def access(self, at) -> np.ndarray:
        """Ids at the given places."""
        at = np.atleast_1d(np.asarray(at, dtype=np.int64)).copy()
        if len(at) and not 0 <= at.min() <= at.max() < self.n:
            raise IndexError("place outside the sequence")
        out = np.zeros(len(at), dtype=np.uint32)
        for plane in range(self.bits):
            bit = (self.words[plane, at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)
            before = self._rank1(plane, at)
            at = np.where(bit == 1, self.zeros[plane] + before, at - before)
            out = (out << 1) | bit.astype(np.uint32)
        return out

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` before ``end`` stand below the last plane."""
        low, high = 0, end
        for plane in range(self.bits):
            a, b = self._rank1(plane, np.array([low, high]))
            if token >> (self.bits - 1 - plane) & 1:
                low, high = self.zeros[plane] + int(a), self.zeros[plane] + int(b)
            else:
                low, high = low - int(a), high - int(b)
        return low, high

    def rank(self, token: int, end: int) -> int:
        """Occurrences of ``token`` before place ``end``."""
        if not 0 <= token < 1 << self.bits or not self.n:
            return 0
        low, high = self._range(token, min(end, self.n))
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Place of occurrence ``k`` (from 0) of ``token``."""
        if not 0 <= k < self.count(token):
            raise IndexError("no such occurrence")
        at = self._range(token, self.n)[0] + k
        for plane in reversed(range(self.bits)):
            at = self._select1(plane, at - self.zeros[plane]) if token >> (self.bits - 1 - plane) & 1 \
                else self._select0(plane, at)
        return at

    def _select1(self, plane: int, k: int) -> int:
        block = int(np.searchsorted(self.ones[plane], k, side="right")) - 1
        return block * _BLOCK + int(np.flatnonzero(self._block(plane, block))[k - int(self.ones[plane, block])])

    def _select0(self, plane: int, k: int) -> int:
        zeros = np.arange(self.ones.shape[1], dtype=np.int64) * _BLOCK - self.ones[plane]
        block = int(np.searchsorted(zeros, k, side="right")) - 1
        return block * _BLOCK + int(np.flatnonzero(~self._block(plane, block))[k - int(zeros[block])])

    def _block(self, plane: int, block: int) -> np.ndarray:
        raw = np.ascontiguousarray(self.words[plane, block * 8:block * 8 + 8]).view(np.uint8)
        return np.unpackbits(raw, bitorder="little").astype(bool)

    def decode(self) -> np.ndarray:
        """All ids in order: the planes' partitions undone from the last to the first."""
        kind = np.dtype("<u2" if self.bits <= 16 else "<u4")
        ids = np.zeros(self.n, dtype=kind)
        for plane in reversed(range(self.bits)):
            bit = self._bits(plane)
            before = np.empty(self.n, dtype=kind)
            before[~bit] = ids[:self.zeros[plane]]
            before[bit] = ids[self.zeros[plane]:] | kind.type(1 << (self.bits - 1 - plane))
            ids = before
        return ids.astype("<u4")


def pack_shard(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, bits: int) -> bytes:
    """A shard file's bytes: header, documents (compressed), wavelet matrix."""
    known = [d is not None for d in doc_ids]
    docs = zlib.compress(
        np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array(known, "u1").tobytes()
        + np.array(lengths, "<u8").tobytes())
    return _MAGIC + struct.pack("<QQ", len(doc_ids), len(docs)) + docs + WaveletMatrix.build(ids, bits).to_bytes()


def read_shard(raw: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, their lengths and the wavelet matrix of a shard file's bytes."""
    if raw[:4] != _MAGIC:
        raise ValueError("not a shard file")
    n, size = struct.unpack_from("<QQ", raw, 4)
    docs = zlib.decompress(raw[20:20 + size])
    known = np.frombuffer(docs, "u1", n, 8 * n)
    doc_ids = [d if k else None for d, k in zip(np.frombuffer(docs, "<i8", n).tolist(), known, strict=True)]
    return doc_ids, np.frombuffer(docs, "<u8", n, 9 * n), WaveletMatrix.from_bytes(memoryview(raw)[20 + size:])


def _dealt(own: DataFrame, n: int) -> DataFrame:
    """Rows ``d, t`` in ranges of id and text hash, sorted: an id that many rows share is dealt over several ranges."""
    order = [F.col("d").asc_nulls_first(), F.xxhash64("t")]
    return own.repartitionByRange(n, *order).sortWithinPartitions(*order, "t")


def write_shards(documents: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS, partitions: int | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id`` and write the shard files below ``path``.

    Columns of the written table: ``part``, ``shard`` (order of the shards),
    ``n_docs``, ``n_tokens``, ``payload``; each file holds one shard.
    """
    vocabulary = vocabulary or vocabulary_path(VOCABULARY)
    spark = documents.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def start():
        encode = encoder(vocabulary)
        bits = max(1, (encode.library.get_vocab_size() - 1).bit_length(), end_id.bit_length())
        end = end_id.to_bytes(4, "little")

        def run(rows: Iterator[tuple]) -> Iterator[tuple]:
            shard, doc_ids, lengths, parts, total, part = 0, [], [], [], 0, 0

            def close() -> tuple:
                ids = np.frombuffer(b"".join(parts), "<u4")
                return part, shard, len(doc_ids), total, pack_shard(doc_ids, lengths, ids, bits)

            for part, doc_id, text in rows:  # noqa: B007
                raw = encode(text or "") + end
                if doc_ids and total + len(raw) // 4 > shard_tokens:
                    yield close()
                    shard, doc_ids, lengths, parts, total = shard + 1, [], [], [], 0
                doc_ids.append(doc_id)
                lengths.append(len(raw) // 4)
                parts.append(raw)
                total += len(raw) // 4
            if doc_ids:
                yield close()

        return run

    own = documents.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t"))
    dealt = _dealt(own, n)
    shards = map_rows(dealt.select(F.spark_partition_id().cast("long").alias("p"), "d", "t"),
                      "part long, shard long, n_docs long, n_tokens long, payload binary", start,
                      batch_rows=4, batch_bytes=1)
    shards.write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part, shard, first``: tokens of all shards before; no payload is read.

    Sums within a partition, then over partitions: the only single task has
    one row per range partition.
    """
    shards = spark.read.parquet(path).select("part", "shard", "n_tokens")
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(parts, "part").select(
        "part", "shard", (F.col("base") + F.col("inner")).alias("first"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the shard files."""

    def start():
        def run(rows: Iterator[tuple]) -> Iterator[tuple]:
            for part, shard, payload in rows:
                doc_ids, lengths, matrix = read_shard(payload)
                raw = matrix.decode().tobytes()
                at = 0
                for doc_id, n in zip(doc_ids, lengths.tolist(), strict=True):
                    yield part, shard, doc_id, at, n, zlib.crc32(raw[4 * at:4 * (at + n)])
                    at += n

        return run

    docs = map_rows(spark.read.parquet(path).select("part", "shard", "payload"),
                    "part long, shard long, doc_id long, inner long, n_tokens long, ids_crc32 long", start)
    return docs.join(shard_starts(spark, path), ["part", "shard"]).select(
        "doc_id", (F.col("first") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
