import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from machinewatch.llm.common import work_folder
from machinewatch.llm.tokenizers import encoder, vocabulary_path
from machinewatch.llm.wavelet import VOCABULARY, WaveletMatrix, _dealt, pack_shard, read_documents, read_shard, write_shards


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
def test_access_rank_select_equal_brute_force(n):
    ids = np.random.default_rng(n).integers(0, 40, n).astype("<u4")
    matrix = WaveletMatrix.from_bytes(memoryview(WaveletMatrix.build(ids, 6).to_bytes()))
    assert (matrix.decode() == ids).all()
    assert (matrix.access(np.arange(n)) == ids).all()
    for token in (0, 7, 39, 41, 63):
        places = np.flatnonzero(ids == token)
        assert matrix.count(token) == len(places)
        assert matrix.rank(token, n // 2) == (ids[:n // 2] == token).sum()
        assert [matrix.select(token, k) for k in range(len(places))] == places.tolist()
        with pytest.raises(IndexError):
            matrix.select(token, len(places))


def test_shard_round_trip():
    raw = pack_shard([None, 5, 9], [1, 2, 1], np.array([3, 4, 5, 6], "<u4"), 3)
    doc_ids, lengths, matrix = read_shard(raw)
    assert (doc_ids, lengths.tolist(), matrix.decode().tolist()) == ([None, 5, 9], [1, 2, 1], [3, 4, 5, 6])


def _expected(rows):
    encode, at, out = encoder(vocabulary_path(VOCABULARY)), 0, []
    for doc_id, text in rows:
        raw = encode(text or "") + bytes(4)
        out.append((doc_id, at, len(raw) // 4, zlib.crc32(raw)))
        at += len(raw) // 4
    return out


def test_documents_read_back_from_many_shards(ready, documents, texts):
    path = work_folder(ready, "test-shards")
    write_shards(documents, path, shard_tokens=3000, partitions=5)
    shards = ready.read.parquet(path)
    assert shards.count() > 10 and shards.selectExpr("max(n_tokens)").first()[0] < 60_000
    got = sorted(tuple(r) for r in read_documents(ready, path).collect())
    assert got == _expected(sorted(texts.items()))


def test_odd_rows(ready, odd, empty):
    path = work_folder(ready, "test-odd")
    write_shards(odd, path, shard_tokens=100)
    got = read_documents(ready, path).orderBy("start").collect()
    assert len(got) == odd.count() and got[0]["doc_id"] is None
    assert [r["doc_id"] for r in got[1:]] == [1, 2, 3, 4, 4, 5, 6, 7, 8, 9]
    text_of = {r["doc_id"]: r["text"] for r in odd.select("doc_id", "text").collect()}
    assert [tuple(r) for r in got] == _expected([(r["doc_id"], text_of[r["doc_id"]]) for r in got])
    path = work_folder(ready, "test-empty")
    write_shards(empty, path)
    assert read_documents(ready, path).count() == 0


def test_a_shared_id_is_dealt_over_partitions(ready):
    """A third of the rows has one id, a tenth none."""
    rows = ready.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 != 0, F.col("id")).alias("d"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("t"))
    sizes = [r["count"] for r in _dealt(rows, 8).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8
