"""Packing of tokenized documents into sequences, by cutting-stock column generation.

A document's whole multiples of the sequence length are sequences of their
own; its rest is an item. Items fall into size classes, the class histogram
goes to the driver (at most one row per length), and column generation finds
patterns of classes that fill a sequence. Pattern counts are rounded down;
items are ranked by length within their class and take the patterns' places
in order of rank. What rounding leaves is filler: it is cut to fill the room
that patterns leave in their sequences, then cut into whole sequences, and
its end into sequences of a power of two. So no sequence is padded.

Job shape: ids are kept once, in a table; all planning uses narrow rows. Ranks
come from counts per (length, input partition), so a length with a third of
all documents is ranked in as many tasks as the input has. Places of filler
follow in closed form from the histogram; the room of sequences is summed in
blocks and matched with filler cell by cell of the common line. Last, the
ids meet their document's pieces in one join.

Defined results: null and empty texts have the end id only; equal ids,
repeated rows and null ids are packed each; an empty table gives no piece.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from machinewatch.llm.common import map_rows, work_folder
from machinewatch.llm.cutting_stock import solve
from machinewatch.llm.tokenizers import encoder, vocabulary_path

VOCABULARY, END_ID, LENGTH = "word_bpe_49k.json", 2, 4096
#: Tokens per size class: the linear program has LENGTH / CLASS rows at most.
CLASS = 16


def encoded(documents: DataFrame, vocabulary: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``row, doc_id, n, ids`` as a table in the shared folder; ``row`` numbers the rows by input partition."""

    def start():
        encode, end = encoder(vocabulary), end_id.to_bytes(4, "little")

        def run(rows: Iterator[tuple]) -> Iterator[tuple]:
            for doc_id, text in rows:
                ids = encode(text or "") + end
                yield doc_id, len(ids) // 4, ids

        return run

    out = map_rows(documents.select(F.col(id_col).cast("long"), text_col), "doc_id long, n long, ids binary", start)
    path = work_folder(documents.sparkSession, "ids")
    out.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.parquet(path)


@dataclass
class Plan:
    """Where items go; everything follows from an item's length and its rank among equal lengths."""

    length: int
    #: Sequences of patterns, and the room left in them.
    n_pattern: int
    room: int
    #: Tokens of filler.
    filler: int
    #: By length: rank in its class of the first item of that length.
    first_rank: dict[int, int]
    #: By class: places taken by patterns, and per stretch of them its first rank, items per sequence, first sequence, first slot.
    places: dict[int, int]
    stretches: dict[int, list[tuple[int, int, int, int]]]
    #: By length: rank in class from which items are filler, and the filler line's place of the first such item.
    filler_rank: dict[int, int]
    filler_at: dict[int, int]

    def pattern_place(self, n: int, rank: int) -> tuple[int, int] | None:
        """Sequence and slot of an item, None for filler."""
        cls, rank = -(-n // CLASS), self.first_rank[n] + rank
        if rank >= self.places[cls]:
            return None
        own = self.stretches[cls]
        first, per, sequence, slot = own[bisect.bisect_right(own, rank, key=lambda s: s[0]) - 1]
        return sequence + (rank - first) // per, slot + (rank - first) % per

    def filler_place(self, n: int, rank: int) -> int:
        """Where a filler item begins on the filler line."""
        return self.filler_at[n] + (self.first_rank[n] + rank - self.filler_rank[n]) * n

    def tail_cuts(self) -> list[int]:
        """Ends of the sequences made of filler that no pattern's room takes."""
        rest = self.filler - self.room
        whole = rest // self.length
        cuts, at = [], self.room + whole * self.length
        for bit in reversed(range(self.length.bit_length())):
            if (rest - whole * self.length) >> bit & 1:
                at += 1 << bit
                cuts.append(at)
        return cuts

    def tail_pieces(self, start: int, end: int) -> Iterator[tuple[int, int, int, int]]:
        """Filler line stretch, beyond the patterns' room, as (from, to, sequence, offset)."""
        last = self.room + (self.filler - self.room) // self.length * self.length
        n_whole, cuts = (last - self.room) // self.length, self.tail_cuts()
        while start < end:
            if start < last:
                k = (start - self.room) // self.length
                low = self.room + k * self.length
                high, sequence = low + self.length, k
            else:
                k = bisect.bisect_right(cuts, start)
                low, high, sequence = cuts[k - 1] if k else last, cuts[k], n_whole + k
            stop = min(end, high)
            yield start, stop, sequence, start - low
            start = stop


def make_plan(histogram: dict[int, int], length: int = LENGTH) -> Plan:
    """Patterns for items of the given lengths (1 to ``length - 1``) and counts."""
    classes: dict[int, list[int]] = {}
    for n in sorted(histogram, reverse=True):
        classes.setdefault(-(-n // CLASS), []).append(n)
    sizes = np.array(sorted(classes), dtype=np.int64)
    demand = np.array([sum(histogram[n] for n in classes[c]) for c in sizes.tolist()], dtype=float)
    patterns, used = solve(sizes, demand, length // CLASS)
    times = np.floor(used + 1e-6).astype(np.int64)

    # Lengths of a class in order of rank; their running counts and tokens.
    counts = {c: np.cumsum([0, *(histogram[n] for n in classes[c])]) for c in sizes.tolist()}
    tokens = {c: np.cumsum([0, *(histogram[n] * n for n in classes[c])]) for c in sizes.tolist()}

    def taken(cls: int, places: int) -> int:
        """Tokens of the first ``places`` items of a class."""
        i = int(np.searchsorted(counts[cls], places, side="right")) - 1
        more = (places - int(counts[cls][i])) * classes[cls][i] if i < len(classes[cls]) else 0
        return int(tokens[cls][i]) + more

    total = sum(n * k for n, k in histogram.items())
    while True:
        places = np.minimum(times @ patterns, demand.astype(np.int64)) if len(times) else np.zeros(0, dtype=np.int64)
        inside = sum(taken(c, int(p)) for c, p in zip(sizes.tolist(), places, strict=True))
        room, filler = int(times.sum()) * length - inside, total - inside
        if room <= filler:
            break
        # Too little filler for the room: give up sequences of the most used pattern.
        most = int(times.argmax())
        times[most] -= min(int(times[most]), -(-(room - filler) // length))

    stretches: dict[int, list[tuple[int, int, int, int]]] = {c: [] for c in classes}
    done, sequence = dict.fromkeys(classes, 0), 0
    for pattern, n_times in zip(patterns, times.tolist(), strict=True):
        slot = 0
        for cls, per in zip(sizes.tolist(), pattern.tolist(), strict=True):
            if per and n_times:
                stretches[cls].append((done[cls], per, sequence, slot))
                done[cls] += per * n_times
                slot += per
        sequence += n_times
    taken_places = dict(zip(sizes.tolist(), places.tolist(), strict=True))
    first_rank, filler_rank, filler_at, at = {}, {}, {}, 0
    for cls in sizes.tolist():
        rank = 0
        for n in classes[cls]:
            first_rank[n] = rank
            filler_rank[n] = max(rank, taken_places[cls])
            rank += histogram[n]
            filler_at[n] = at
            at += max(0, rank - filler_rank[n]) * n
    return Plan(length, sequence, room, filler, first_rank, taken_places, stretches, filler_rank, filler_at)


def pack_documents(documents: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, length: int = LENGTH,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, length, doc_tokens, sequence_id, offset, ids`` of every piece.

    ``ids`` are little-endian unsigned 32-bit integers; ``start`` counts the
    document's ids before the piece, ``offset`` the sequence's.
    """
    spark = documents.sparkSession
    tokens = encoded(documents, vocabulary or vocabulary_path(VOCABULARY), end_id, id_col, text_col)
    narrow = tokens.select("row", "n", F.shiftright("row", 33).alias("part"), (F.col("n") % length).alias("r"),
                           F.floor(F.col("n") / length).alias("full"))
    rows = narrow.groupBy("r").agg(F.count(F.lit(1)).alias("k"), F.sum("full").alias("full")).collect()  # length rows
    plan = make_plan({r["r"]: r["k"] for r in rows if r["r"]}, length)
    n_full = sum(r["full"] for r in rows)
    shared = spark.sparkContext.broadcast(plan)

    # Rank among equal lengths: counts per (length, partition), then within them.
    items = narrow.where("r > 0")
    before = Window.partitionBy("r").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = items.groupBy("r", "part").agg(F.count(F.lit(1)).alias("k")).select(
        "r", "part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("base"))
    ranked = items.withColumn("i", F.row_number().over(Window.partitionBy("r", "part").orderBy("row")) - 1).join(
        counts, ["r", "part"]).select("row", "r", (F.col("n") - F.col("r")).alias("start"),
                                      (F.col("i") + F.col("base")).alias("rank"))

    def place():
        own = shared.value

        def run(batch: Iterator[tuple]) -> Iterator[tuple]:
            for row, r, start, rank in batch:
                found = own.pattern_place(r, rank)
                if found:
                    yield row, start, r, found[0], found[1], None
                else:
                    yield row, start, r, None, None, own.filler_place(r, rank)

        return run

    placed = map_rows(ranked, "row long, start long, length long, sequence_id long, slot long, line long", place,
                      batch_rows=10_000)
    path = work_folder(spark, "places")
    placed.write.parquet(path)
    placed = spark.read.parquet(path)

    # Items at a pattern's place, and the room behind them.
    in_order = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    patterned = placed.where("sequence_id is not null").withColumn(
        "offset", F.coalesce(F.sum("length").over(in_order), F.lit(0)))
    pieces = patterned.select("row", "start", "length", "sequence_id", "offset")

    # Filler: first the patterns' room, by overlap on the common line, then sequences of its own.
    filler = placed.where("line is not null").select("row", "start", "line", (F.col("line") + F.col("length")).alias("to"))
    block = max(1024, math.isqrt(max(plan.n_pattern, 1)))
    rooms = placed.where("sequence_id is not null").groupBy("sequence_id").agg(F.sum("length").alias("filled")).select(
        "sequence_id", "filled", (length - F.col("filled")).alias("room"),
        F.floor(F.col("sequence_id") / block).alias("block")).where("room > 0")
    of_block = Window.partitionBy("block").orderBy("sequence_id").rowsBetween(Window.unboundedPreceding, -1)
    # As many rows as the square root of the number of sequences (or one per 1,024 of them).
    blocks = rooms.groupBy("block").agg(F.sum("room").alias("sum")).select("block", F.coalesce(F.sum("sum").over(
        Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    lines = rooms.withColumn("inner", F.coalesce(F.sum("room").over(of_block), F.lit(0))).join(blocks, "block").select(
        "sequence_id", "filled", (F.col("base") + F.col("inner")).alias("low"),
        (F.col("base") + F.col("inner") + F.col("room")).alias("high"))

    def cells(low: str, high: str):
        return F.explode(F.sequence(F.floor(F.col(low) / length), F.floor((F.col(high) - 1) / length)))

    gaps = lines.withColumn("cell", cells("low", "high"))
    fillings = filler.where(F.col("line") < plan.room).withColumn("cell", cells("line", "to"))
    start_of, end_of = F.greatest("line", "low"), F.least("to", "high")
    # Both sides are cut to cells; an overlap is taken in the cell where it begins.
    met = fillings.join(gaps, (fillings["cell"] == gaps["cell"]) & (start_of < end_of) & (
        F.floor(start_of / length) == gaps["cell"]))
    pieces = pieces.unionByName(met.select(
        "row", (F.col("start") + start_of - F.col("line")).alias("start"), (end_of - start_of).alias("length"),
        "sequence_id", (F.col("filled") + start_of - F.col("low")).alias("offset")))

    first_own = plan.n_pattern + n_full

    def cut():
        own = shared.value

        def run(batch: Iterator[tuple]) -> Iterator[tuple]:
            for row, start, line, to in batch:
                for a, b, sequence, offset in own.tail_pieces(max(line, own.room), to):
                    yield row, start + a - line, b - a, first_own + sequence, offset

        return run

    piece = "row long, start long, length long, sequence_id long, offset long"
    pieces = pieces.unionByName(map_rows(filler.where(F.col("to") > plan.room), piece, cut))

    # Whole sequences of long documents, numbered by sums per partition.
    long = narrow.where("full > 0")
    sums = long.groupBy("part").agg(F.sum("full").alias("k")).select("part", F.coalesce(F.sum("k").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    of_part = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    numbered = long.withColumn("inner", F.coalesce(F.sum("full").over(of_part), F.lit(0))).join(sums, "part")
    whole = numbered.select("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("k"),
                            (F.col("base") + F.col("inner") + plan.n_pattern).alias("first")).select(
        "row", (F.col("k") * length).alias("start"), F.lit(length).cast("long").alias("length"),
        (F.col("first") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    pieces = pieces.unionByName(whole)

    # A document's pieces meet its ids once.
    of_row = pieces.groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("ps"))
    joined = tokens.join(of_row, "row")
    cut_ids = F.transform("ps", lambda p: F.struct(
        p["start"].alias("start"), p["length"].alias("length"), p["sequence_id"].alias("sequence_id"),
        p["offset"].alias("offset"),
        F.substr(F.col("ids"), (p["start"] * 4 + 1).cast("int"), (p["length"] * 4).cast("int")).alias("ids")))
    return joined.select("doc_id", F.col("n").alias("doc_tokens"), F.explode(cut_ids).alias("p")).select(
        "doc_id", "p.start", "p.length", "doc_tokens", "p.sequence_id", "p.offset", "p.ids")


def with_crc(pieces: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")
