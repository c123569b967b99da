"""Benchmark passages in documents, by a prefix-filtered set join.

An item's windows are its runs of ``WINDOW`` words (the whole item, if it has
fewer). A window is a set of shingles; as it must be contained whole, one of
its shingles is a necessary prefix: the rarest one in the corpus, which joins
with the fewest document positions. A document position with that shingle is
a candidate if the window, laid at that offset, lies inside the document
(positional and length bound); its words are then compared exactly. Words in
any confirmed window are hit.

Job shape: the benchmark is taken in blocks of at most ``BLOCK_BYTES`` of
text, each by a bounded broadcast; every block is one pass over all documents
without a shuffle (and one to count the corpus frequency of its shingles,
summed per task first). Only if there is more than one block are the blocks'
hits brought together by document.

Defined results: null text has no words and no hit; an item without words has
no window; equal items all count; an item without an id hits words like any
other, and is not among the ids; repeated documents are judged each; an empty
benchmark contaminates nothing.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from machinewatch.llm.common import map_rows, per_text, written

#: Words of a window and of a shingle; bytes of item texts in one broadcast block.
WINDOW, SHINGLE = 10, 3
BLOCK_BYTES = 4 << 20

#: Bytes of a word: digits, letters (A-Z in lower case) and everything beyond ASCII.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))

Words = tuple[bytes, ...]


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


def windows_of(words: list[bytes], window: int = WINDOW) -> list[Words]:
    if not words:
        return []
    return [tuple(words[i:i + window]) for i in range(max(1, len(words) - window + 1))]


def shingles_of(words: Words | list[bytes], size: int) -> list[Words]:
    return list(zip(*(words[i:] for i in range(size)), strict=False))


class WindowIndex:
    """A block's windows by their necessary prefix."""

    def __init__(self, items: list[tuple[int | None, str]], window: int = WINDOW, shingle: int = SHINGLE):
        self.items_of: dict[Words, list[int | None]] = {}
        for item_id, text in items:
            for w in set(windows_of(words_of(text), window)):
                self.items_of.setdefault(w, []).append(item_id)
        # Windows of fewer words than a shingle have shingles of their own size.
        self.shingle = shingle
        self.sizes = sorted({min(shingle, len(w)) for w in self.items_of})
        self.prefix: dict[int, dict[Words, list[tuple[int, Words]]]] = {}

    def shingles(self) -> dict[int, set[Words]]:
        out: dict[int, set[Words]] = {n: set() for n in self.sizes}
        for w in self.items_of:
            n = min(self.shingle, len(w))
            out[n].update(shingles_of(w, n))
        return out

    def order(self, frequency: dict[Words, int]) -> WindowIndex:
        """Choose each window's rarest shingle (equal ones: the first in byte order)."""
        self.prefix = {n: {} for n in self.sizes}
        for w in sorted(self.items_of):
            n = min(self.shingle, len(w))
            own = shingles_of(w, n)
            at = min(range(len(own)), key=lambda i: (frequency.get(own[i], 0), own[i], i))
            self.prefix[n].setdefault(own[at], []).append((at, w))
        return self

    def find(self, words: list[bytes]) -> list[tuple[int, int, Words]]:
        """Confirmed windows: first word, past the last word, window."""
        out = []
        for n, prefix in self.prefix.items():
            for i, s in enumerate(zip(*(words[k:] for k in range(n)), strict=False)):
                if s in prefix:
                    for at, w in prefix[s]:
                        start = i - at
                        if start >= 0 and start + len(w) <= len(words) and tuple(words[start:start + len(w)]) == w:
                            out.append((start, start + len(w), w))
        return out

    def judge(self, text: str | None) -> tuple[int, list[int], list[int]]:
        """Words, hit stretches (starts and ends in turn, apart from each other) and ids of found items."""
        words = words_of(text)
        found = self.find(words)
        ids = sorted({i for w in {w for *_, w in found} for i in self.items_of[w] if i is not None})
        return len(words), merge((a, b) for a, b, _ in found), ids


def merge(stretches) -> list[int]:
    """Union of half-open stretches as a flat list of starts and ends."""
    out: list[int] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    """The benchmark's items in blocks of at most ``block_bytes`` of text (or one longer item)."""
    block, size = [], 0
    rows = benchmark.where(F.col(text_col).isNotNull()).select(id_col, text_col)
    for item_id, text in rows.toLocalIterator():
        n = len(text.encode())
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += n
    if block:
        yield block


def build_index(documents: DataFrame, items: list[tuple[int | None, str]], text_col: str = "text", window: int = WINDOW,
                shingle: int = SHINGLE) -> WindowIndex:
    """Index of one block, its shingles ordered by their frequency in all documents."""
    index = WindowIndex(items, window, shingle)
    if not index.sizes:
        return index.order({})
    wanted = documents.sparkSession.sparkContext.broadcast(index.shingles())

    def start():
        sets = wanted.value

        def run(rows: Iterator[tuple]) -> Iterator[tuple]:
            counts: Counter = Counter()
            for (text,) in rows:
                words = words_of(text)
                for n, known in sets.items():
                    counts.update([s for s in zip(*(words[k:] for k in range(n)), strict=False) if s in known])
            yield from ((b" ".join(s), n) for s, n in counts.items())

        return run

    counted = map_rows(documents.select(text_col), "shingle binary, n long", start, batch_rows=20_000)
    sums = counted.groupBy("shingle").agg(F.sum("n").alias("n")).collect()  # at most the block's shingles
    return index.order({tuple(bytes(r["shingle"]).split(b" ")): r["n"] for r in sums})


def hits(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``id_col, n_words, stretches array<long>, items array<long>`` per document.

    ``stretches``: starts and ends (past the last word) of the hit stretches, in turn.
    """
    parts = []
    for items in blocks_of(benchmark, item_col, item_text_col, block_bytes):
        parts.append(_block_hits(documents, build_index(documents, items, text_col, window, shingle), id_col, text_col))
    if not parts:
        parts = [_block_hits(documents, WindowIndex([]).order({}), id_col, text_col)]
    if len(parts) == 1:
        return parts[0].drop("_text")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    # Rows with equal id and text have the same hits; each stands ``len(parts)`` times here.
    joined = every.groupBy(id_col, "_text").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("stretches")).alias("s"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.expr(f"cast(count(*) / {len(parts)} as int)").alias("times"))
    merged = F.udf(lambda s: merge(zip(s[::2], s[1::2], strict=True)), "array<long>", useArrow=True)
    return joined.select(id_col, "n_words", merged("s").alias("stretches"), "items",
                         F.explode(F.sequence(F.lit(1), "times")).alias("_n")).drop("_n")


def _block_hits(documents: DataFrame, index: WindowIndex, id_col: str, text_col: str) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(index)
    udf = per_text("n_words long, stretches array<long>, items array<long>", lambda: shared.value.judge)
    return documents.select(
        id_col, F.xxhash64(text_col).alias("_text"), udf(F.col(text_col)).alias("_r")).select(id_col, "_text", "_r.*")


def decontaminate(documents: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per document."""
    found = hits(documents, benchmark, **names)
    n_hit = F.aggregate(
        F.transform("stretches", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"),
        lambda a, x: a + x)
    names_of = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        names.get("id_col", "doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names_of, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(documents: DataFrame, benchmark: DataFrame, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without a benchmark passage, with all their columns.

    What a block leaves is written before the next one reads it, so each block
    judges and counts once what is left, not through all earlier blocks again.
    """
    for n, items in enumerate(blocks_of(benchmark, "item_id", "text", block_bytes)):
        if n:
            documents = written(documents, f"clean-{n}")
        shared = documents.sparkSession.sparkContext.broadcast(build_index(documents, items, text_col))
        udf = per_text("n long", lambda shared=shared: lambda text: (len(shared.value.find(words_of(text))),))
        documents = documents.where(udf(F.col(text_col))["n"] == 0)
    return documents
