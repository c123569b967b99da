"""Prefix trie of conversations by van Emde Boas recursion.

A trie of 2^k layers is cut at half its depth: the prefixes that end at the
cut are named, which gives the upper trie and, below each name, a forest of
lower tries; all of these are cut again at half their own depth, every trie of
a level in the same job, until each has one layer. A cut prefix's name is the
digest of its trie's own name and of the block of turns down to the cut; block
digests come from pairs of half blocks. Totals go the other way: a level's
upper tries take over the totals of the lower forests grafted below them.

Job shape: a row is a turn, never a whole conversation, so a conversation with
a third of all turns is spread over its depth. With 2^k layers there are k
levels; naming moves a row per named depth, grafting at most a row per turn.
A lower tree's totals reach the layers above it along one member, its
smallest, so a level adds up no more rows than there are turns. Names that
many conversations share are salted by conversation before the smallest is
looked up, and counted map-side. Levels are written to the shared folder.

Defined results: rows without a conversation id belong to no conversation and
are left out; null roles and texts are empty; turns go by turn (null first),
turns of one number by the digest of role and text, and repeated rows are
turns each; conversations may be empty once rebuilt, and end at the root; an
empty table has no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from machinewatch.llm.common import map_rows, work_folder, written
from machinewatch.operators.ranges import in_ranges, running_offsets

#: Conversations borrow up to three turns of the first one of their twenty.
FAMILY, BORROWED = 20, 4
#: Salts of a shared name, copies of a row repeated in one go, layers of a graft's join key.
SALTS, COPIES, CHUNK_BITS = 64, 4096, 10
#: Ids of a block of the end lists: at most 2^10.
ID_BITS = 10
WORD = r"[^\x20\x09-\x0D]+"


def _expanded(rows: DataFrame, first: Column, copies: Column, name: str, most: int) -> DataFrame:
    """Each row once per copy, numbered from ``first``; a row of many copies is dealt in blocks."""
    rows = rows.withColumn("_first", first).withColumn("_copies", copies).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / COPIES))))
    if most > COPIES:
        rows = rows.repartition("conv", "_first", "_block")
    low = F.col("_first") + F.col("_block") * COPIES
    high = F.least(low + (COPIES - 1), F.col("_first") + F.col("_copies") - 1)
    return rows.withColumn(name, F.explode(F.sequence(low, high))).drop("_first", "_copies", "_block")


def rebuilt_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """``conv, d, digest, words`` per turn of the rebuilt conversations, and a row of depth 0 for each conversation.

    Conversation c takes its first h = crc32(c) % 4 turns from conversation
    c - c % 20, as far as that has them, and keeps its own after its first h.
    """
    spark = conversations.sparkSession
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    turns = turns.groupBy("conv", "turn", "digest").agg(F.max("words").alias("words"), F.count(F.lit(1)).alias("copies"))
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    turns = in_ranges(turns, [F.col("conv"), *order], work_folder(spark, "trie-turns"))

    # Places of a range's turns, and what each conversation borrows.
    sizes = turns.groupBy("conv").agg(F.sum("copies").alias("size"))
    convs = sizes.withColumn("h", (F.crc32(F.col("conv").cast("string").cast("binary")) % BORROWED)).withColumn(
        "base", F.col("conv") - F.col("conv") % FAMILY)
    convs = convs.join(sizes.select(F.col("conv").alias("base"), F.col("size").alias("base_size")), "base", "left")
    convs = written(convs.select("conv", "base", "h", F.least("h", F.coalesce("base_size", F.lit(0))).alias("k")), "trie-convs")
    places = running_offsets(turns, F.col("copies"), ["conv"]).join(convs.select("conv", "h", "k"), "conv")
    before = F.coalesce(F.sum("copies").over(Window.partitionBy("conv", "part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    placed = turns.withColumn("before", before).join(places, ["conv", "part"])
    most = turns.agg(F.max("copies")).first()[0] or 0
    placed = _expanded(placed, F.col("offset") + F.col("before") + 1, F.col("copies"), "pos", most)

    own = placed.where(F.col("pos") > F.col("h")).select("conv", (F.col("pos") - F.col("h") + F.col("k")).alias("d"), "digest",
                                                        "words")
    heads = placed.where((F.col("pos") < BORROWED) & (F.col("conv") % FAMILY == 0)).select(
        F.col("conv").alias("base"), "pos", "digest", "words")
    lent = heads.join(convs.where("k > 0").select("conv", "base", "k"), "base").where(F.col("pos") <= F.col("k")).select(
        "conv", F.col("pos").alias("d"), "digest", "words")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv", zero.alias("d"), F.lit("").alias("digest"), zero.alias("words"))
    return written(own.unionByName(lent).unionByName(roots), "trie-rebuilt")


def _shifted(value: Column, bits: int) -> Column:
    return F.shiftright(value, bits)


def _named(turns: DataFrame, levels: int) -> DataFrame:
    """``conv, d, name`` of every prefix, cut by cut."""
    spark = turns.sparkSession
    # Digests of whole blocks of 2^k turns, block t of level k from blocks 2t and 2t + 1 of level k - 1.
    blocks = [turns.where("d > 0").select("conv", (F.col("d") - 1).alias("t"), "digest")]
    for k in range(1, levels):
        odd = F.col("t") % 2 == 1
        pair = blocks[-1].groupBy("conv", F.shiftright("t", 1).alias("half")).agg(
            F.max(F.when(~odd, F.col("digest"))).alias("left"), F.max(F.when(odd, F.col("digest"))).alias("right"))
        blocks.append(written(pair.where(F.col("left").isNotNull() & F.col("right").isNotNull()).select(
            "conv", F.col("half").alias("t"), F.sha2(F.concat("left", "right"), 256).alias("digest")), f"trie-blocks-{k}"))

    path = work_folder(spark, "trie-names")
    turns.where("d = 0").select("conv", "d", F.lit("").alias("name")).write.parquet(f"{path}/level={levels}")
    for k in reversed(range(levels)):
        known = spark.read.schema("conv long, d long, name string, level int").parquet(path).select(
            "conv", _shifted(F.col("d"), k).alias("t"), "name")
        cut = known.join(blocks[k].where("t % 2 = 0"), ["conv", "t"]).select(
            "conv", F.shiftleft(F.col("t") + 1, k).alias("d"), F.sha2(F.concat("name", "digest"), 256).alias("name"))
        cut.write.parquet(f"{path}/level={k}")
    return spark.read.schema("conv long, d long, name string, level int").parquet(path).select("conv", "d", "name")


def _represented(names: DataFrame) -> DataFrame:
    """``conv, d, rep``: each prefix's node, known by its depth and smallest member."""
    salted = names.withColumn("salt", F.pmod(F.xxhash64("conv"), F.lit(SALTS)))
    parts = salted.groupBy("d", "name", "salt").agg(F.min("conv").alias("least"))
    reps = parts.groupBy("d", "name").agg(F.min("least").alias("rep"))
    known = parts.select("d", "name", "salt").join(reps, ["d", "name"])
    return salted.join(known, ["d", "name", "salt"]).select("conv", "d", "rep")


def _end_lists(rows: DataFrame) -> DataFrame:
    """``rep, d, ends_sha256`` of the nodes where members end: ids are hashed as they stream by, in order."""
    ends = rows.groupBy("conv").agg(F.max(F.struct("d", "rep")).alias("end")).select("conv", "end.d", "end.rep")
    listed = ends.groupBy("rep", "d", F.shiftright("conv", ID_BITS).alias("block")).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    streamed = listed.repartition("rep", "d").sortWithinPartitions("rep", "d", "block").select("rep", "d", "ids")

    def start():
        def run(blocks: Iterator[tuple]) -> Iterator[tuple]:
            node, digest = None, None
            for rep, d, ids in blocks:
                if (rep, d) == node:
                    digest.update(b"," + ids.encode())
                    continue
                if node:
                    yield *node, digest.hexdigest()
                node, digest = (rep, d), hashlib.sha256(ids.encode())
            if node:
                yield *node, digest.hexdigest()
        return run

    return map_rows(streamed, "rep long, d long, ends_sha256 string", start)


def _grafted(rows: DataFrame, nodes: DataFrame, levels: int) -> DataFrame:
    """``rep, d, leaves, saved``: totals of each node's subtree."""
    totals = nodes.select("rep", "d", (F.col("n_children") == 0).cast("long").alias("leaves"), "saved")
    for k in range(levels):
        bits = min(k, CHUNK_BITS)
        chunks = F.sequence(_shifted(F.col("d") - (1 << k), bits), _shifted(F.col("d"), bits) - 1)
        lower = totals.where(F.col("d") % (2 << k) == 1 << k).select(
            F.col("rep").alias("conv"), F.explode(chunks).alias("chunk"), "leaves", "saved")
        upper = rows.where(F.col("d").bitwiseAND(F.lit(1 << k)) == 0).withColumn("chunk", _shifted(F.col("d"), bits))
        gained = upper.join(lower, ["conv", "chunk"]).select("rep", "d", "leaves", "saved")
        totals = written(totals.unionByName(gained).groupBy("rep", "d").agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), f"trie-totals-{k}")
    return totals


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie over ``turns`` (``conv, d, digest, words``; depth 0 is a conversation's root row).

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256`` per node; ``conv_id`` is the smallest member.
    """
    levels = int(turns.agg(F.max("d")).first()[0] or 0).bit_length()
    rows = written(_represented(_named(turns, levels)), "trie-rows")

    members = rows.groupBy("rep", "d").agg(F.count(F.lit(1)).alias("n_convs"))
    # A node's own row is its smallest member's; that member's row one layer up knows the parent.
    own = rows.where(F.col("conv") == F.col("rep")).select("rep", "d")
    above = rows.select(F.col("conv").alias("rep"), (F.col("d") + 1).alias("d"), F.col("rep").alias("parent"))
    linked = own.join(above, ["rep", "d"], "left")
    children = linked.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("rep"), (F.col("d") - 1).alias("d")).agg(
        F.count(F.lit(1)).alias("n_children"))
    words = turns.select(F.col("conv").alias("rep"), "d", "words")
    nodes = linked.join(members, ["rep", "d"]).join(words, ["rep", "d"]).join(children, ["rep", "d"], "left")
    nodes = written(nodes.select("rep", "d", "parent", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias(
        "n_children"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "trie-nodes")

    totals = _grafted(rows, nodes, levels).select("rep", "d", "leaves", F.col("saved").alias("saved_tokens"))
    out = nodes.drop("saved").join(totals, ["rep", "d"]).join(_end_lists(rows), ["rep", "d"], "left")
    return out.select(
        F.col("rep").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs",
        "n_children", F.col("leaves").alias("n_leaves"), "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
