"""SimHash near-duplicates by multi-index hashing.

A fingerprint has a bit set where more than half of the hashes of a text's
shingles have it. Fingerprints of at most ``radius`` differing bits are
linked. The 64 bits are cut into segments; by the pigeonhole principle a
linked pair differs by at most ``radius // segments`` bits in one of them, so
a small Hamming ball around each segment value is enumerated, the table's
fingerprints with such a value are fetched, and whole distances are verified.
As links go both ways, a ball of one bit is enumerated only upwards (of two
values that differ in one bit, the one with the zero asks for the other).

Job shape: texts are read once; only (id, fingerprint) is kept, as a table.
Equal fingerprints are one node (a group of copies costs one row after
map-side sums). Segments follow from the number of nodes, so that a bucket of
unrelated fingerprints stays small: three of them up to ``MANY`` nodes, beyond
that two of 32 bits, one with a ball of two bits. Buckets of up to ``CROWD``
entries are joined in the JVM. Larger buckets, where a third of all
fingerprints may lie, are dealt into chunks of the table's own entries and of
all entries; a pair of chunks is one small task group that returns only a
spanning forest of its links, so no group's pairs are ever listed and none is
skipped. A value that is only asked for has nothing to be fetched.
Components follow from rounds of star contraction on the links, each round
written to the shared folder.

Defined results: null and empty texts have fingerprint zero, linked like any
other; equal ids keep all their rows; ``component_id`` is the least id.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from machinewatch.llm.common import fresh, per_text, written

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Bit widths of the segments, from the least significant: up to that many nodes, and beyond.
SEGMENTS, MANY, WIDE = (22, 21, 21), 1 << 25, (32, 32)
#: Entries of a bucket joined in the JVM, and of a chunk of a larger one.
CROWD, CHUNK = 512, 8192


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a whole text, as a signed 64-bit integer."""
    words = text.encode().lower().split() if text else []  # on bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    sums, total = np.zeros(64, dtype=np.int64), n
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 65536):  # a very long text is hashed in stretches
        hashes = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(starts[at:min(n, at + 65536)].tolist(), last[at:at + 65536].tolist(), strict=True)], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(2 * sums > total, bitorder="little").view("<u8")[0]
    return int(value.astype(np.int64))


def fingerprints(documents: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` of every document."""
    udf = per_text("fp long", lambda: lambda text: (fingerprint(text, shingle),))
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), udf(F.col(text_col))["fp"].alias("fp"))


def _entries(nodes: DataFrame, radius: int, segments: tuple[int, ...] = SEGMENTS) -> DataFrame:
    """``fp, key, probe``: a node's own segment values, and those around them that it asks for.

    With ``radius = a * segments + b`` a linked pair differs by at most ``a``
    bits in one of the first ``b + 1`` segments or by at most ``a - 1`` in
    another one.
    """
    whole, rest = divmod(radius, len(segments))
    entries, shift = [], 0
    for number, width in enumerate(segments):
        value = F.shiftrightunsigned(F.col("fp"), shift).bitwiseAND(F.lit((1 << width) - 1))
        key = value.bitwiseOR(F.lit(number << 32))
        entries.append(F.array(F.struct(key.alias("key"), F.lit(False).alias("probe"))))
        ball = whole if number <= rest else whole - 1
        masks = [sum(1 << i for i in bits) for n in range(1, ball + 1) for bits in combinations(range(width), n)]
        if masks:
            # Of two values that differ in one bit, the one with the zero asks.
            entries.append(_asked(key, F.array(*(F.lit(m).cast("long") for m in masks)), ball == 1))
        shift += width
    return nodes.select("fp", F.explode(F.concat(*entries)).alias("e")).select("fp", "e.*")


def _asked(key: Column, masks: Column, upwards: bool) -> Column:
    """Entries for a key's flips by the given masks."""
    if upwards:
        masks = F.filter(masks, lambda m: key.bitwiseAND(m) == 0)
    return F.transform(masks, lambda m: F.struct(key.bitwiseXOR(m).alias("key"), F.lit(True).alias("probe")))


def _forest(left: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two chunks."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for value in left:
        for other in right[np.bitwise_count(value ^ right) <= radius].tolist():
            a, b = root(int(value)), root(other)
            if a != b:
                parent[a] = b
                out.append((int(value), other))
    return out


def links(nodes: DataFrame, radius: int = RADIUS, crowd: int = CROWD, chunk: int = CHUNK,
          segments: tuple[int, ...] | None = None) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``), enough to connect every component."""
    if segments is None:
        segments = SEGMENTS if nodes.count() <= MANY else WIDE
    entries = _entries(nodes, radius, segments)
    crowds = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("probe")).alias("own")).where(
        F.col("n") > crowd)
    small, large = entries.join(crowds, "key", "left_anti"), entries.join(crowds.where("own > 0"), "key")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    table = small.where(~F.col("probe")).select("key", F.col("fp").alias("a"))
    asking = small.select("key", F.col("fp").alias("b"), "probe")
    pairs = table.join(asking, (table["key"] == asking["key"]) & near & (F.col("probe") | (F.col("a") < F.col("b")))
                       ).select("a", "b").distinct()

    # Larger buckets: chunks of the table's own entries meet chunks of all entries; an own entry stands in both.
    def dealt(rows: DataFrame, mine: Column, others: Column, own: bool) -> DataFrame:
        k, o = F.ceil(mine / chunk), F.ceil(others / chunk)
        place = F.pmod(F.xxhash64("fp"), k).cast("int")
        across = F.explode(F.sequence(F.lit(0), o.cast("int") - 1))
        at, over = ("t", "q") if own else ("q", "t")
        return rows.select("key", "fp", F.lit(own).alias("own"), place.alias(at), across.alias(over)).select(
            "key", "t", "q", "fp", "own")

    both = dealt(large.where(~F.col("probe")), F.col("own"), F.col("n"), True).unionByName(
        dealt(large, F.col("n"), F.col("own"), False))

    def forest(group: pd.DataFrame) -> pd.DataFrame:
        fp, own = group["fp"].to_numpy().view(np.uint64), group["own"].to_numpy()
        found = np.array(_forest(fp[own], fp[~own], radius), dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    crowded = both.groupBy("key", "t", "q").applyInPandas(forest, "a long, b long")
    return pairs.unionByName(crowded.where("a <> b"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the least node reachable) of all nodes with an edge.

    Rounds of large-star and small-star: each links a node's greater, then its
    smaller neighbours to the least one, until no link changes. The number of
    rounds grows with the logarithm of a component's size.
    """
    current = written(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    state = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        current = written(small, "edges")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = now


def _named(nodes: DataFrame, radius: int, crowd: int, chunk: int) -> DataFrame:
    """``fp, component_id`` of every node ``fp, least``: a component is named by its least document, not by its least fingerprint."""
    parts = components(links(nodes.select("fp"), radius, crowd, chunk)).withColumnRenamed("node", "fp")
    named = nodes.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return named.join(least, "component").select("fp", "component_id")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id",
                    text_col: str = "text", crowd: int = CROWD, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document."""
    prints = written(fingerprints(documents, shingle, id_col, text_col), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    of = _named(nodes, radius, crowd, chunk)
    return prints.join(of, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One document of each component, with all its columns: the least id (rows without one last), then the least text hash.

    Of rows with equal id and text any one stays.
    """
    udf = per_text("fp long", lambda: lambda text: (fingerprint(text, shingle),))
    prints = documents.select(
        F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("d"), F.xxhash64(text_col).alias("h")).alias("row"),
        udf(F.col(text_col))["fp"].alias("fp"))
    nodes = written(prints.groupBy("fp").agg(F.min("row").alias("least")), "nodes")
    key, hashed, row = (fresh(documents, n) for n in ("_stay", "_hash", "_row"))
    stay = _named(nodes, radius, CROWD, CHUNK).select(
        F.col("component_id.d").alias(key), F.col("component_id.h").alias(hashed)).distinct()
    kept = documents.withColumn(row, F.xxhash64(text_col)).join(
        stay, F.col(id_col).eqNullSafe(F.col(key)) & (F.col(row) == F.col(hashed)), "left_semi")
    # Equal rows meet after each task has left one of them.
    return kept.dropDuplicates([id_col, row]).drop(row)
