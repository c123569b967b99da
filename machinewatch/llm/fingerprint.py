"""Document fingerprints: a homomorphic multiset hash of paragraph pieces.

A text and a closing line break are cut into pieces: a line, a sentence of a
line, or 64 code points of a longer sentence. Every piece is hashed to a wide
vector, and the fingerprint is the sum of the vectors of all pieces, each lane
modulo a power of two:

* ``dense``: 8 lanes of 32 random bits, modulo 2^32, for equality;
* ``counts``: 120 lanes of one random bit, modulo 2^16, packed three to a long;
  twice a lane less the number of pieces is a random sum of signs, so inner
  products of two fingerprints estimate those of the two multisets;
* ``n``: the number of pieces, modulo 2^32.

Sums do not depend on order, so texts of the same pieces have the same
fingerprint, and pieces are inserted (``added``) or deleted (``removed``)
without the rest of the text. ``likeness`` is twice the inner product over the
sum of the squared norms, from 0 to 1: the shared part of both multisets, with
a standard error of about 0.09.

Job shape: DataFrame functions only. A fingerprint is a fold within its row.
The next document comes from the order of ids and hashes alone, dealt over
ranges; texts meet by key, in one shuffle of whole texts and one of the halves
that they give away. Equal rows are combined before they are shuffled.

Defined results: null text is empty, and an empty text is one empty line; rows
follow each other by descending id, null ids last, equal ids by the text's
SHA-256; of equal rows each is the next of the one before it; a single row is
its own next; an empty table gives no row. Every input row gives one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from machinewatch.llm.common import work_folder, written
from machinewatch.operators.ranges import in_ranges

#: A piece: up to the first line break or sentence end within 64 code points, else 64 code points.
PIECE = r"(?s).{0,63}?(?:\n|[.!?] )|.{1,64}"
#: Hashes of a piece for the counting and for the dense lanes.
COUNT_HASHES, DENSE_HASHES = 2, 4
#: Packed lanes: at bits 0, 20 and 40, 16 bits each, with room above for a carry.
SPACING, PER_LONG, LANE_BITS = 20, 3, 16
_ONES = sum(1 << (SPACING * i) for i in range(PER_LONG))
_LANES = _ONES * ((1 << LANE_BITS) - 1)
_GUARDS = _ONES << LANE_BITS
_DENSE = (1 << 32) - 1
#: Copies of one row that a task repeats in one go.
COPIES = 4096


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))


def fold(items: Column) -> Column:
    """Sum of the vectors of an array of pieces: struct ``n, dense, counts``."""
    def lane(hashes: Column, take: Callable[[Column], Column], mask: int) -> Column:
        return F.aggregate(hashes, _long(0), lambda a, h: (a + take(h)).bitwiseAND(_long(mask)))

    def bits(shift: int) -> Callable[[Column], Column]:
        return lambda h: F.shiftright(h, shift).bitwiseAND(_long(_ONES))

    def sums(hashes: Column) -> Column:
        low, high = (lambda h: h.bitwiseAND(_long(_DENSE))), (lambda h: F.shiftrightunsigned(h, 32))
        return F.struct(
            F.size(hashes[0]).cast("long").alias("n"),
            F.array(*[lane(hashes[COUNT_HASHES + i], half, _DENSE)
                      for i in range(DENSE_HASHES) for half in (low, high)]).alias("dense"),
            F.array(*[lane(hashes[i], bits(shift), _LANES)
                      for i in range(COUNT_HASHES) for shift in range(SPACING)]).alias("counts"))

    def of_digests(digests: Column) -> Column:
        # The lane's number comes first: each lane hashes the whole digest from a seed of its own.
        return _let(F.array(*[F.transform(digests, _seeded(i)) for i in range(COUNT_HASHES + DENSE_HASHES)]), sums)

    return _let(F.transform(items, lambda p: F.sha2(p, 256)), of_digests)


def _seeded(i: int) -> Callable[[Column], Column]:
    return lambda digest: F.xxhash64(F.lit(i), digest)


def fingerprint(text: Column) -> Column:
    """Fingerprint of a text, which must not be null."""
    return fold(pieces(F.concat(text, F.lit("\n"))))


def added(a: Column, b: Column) -> Column:
    """Fingerprint of both multisets together."""
    return F.struct(
        (a["n"] + b["n"]).bitwiseAND(_long(_DENSE)).alias("n"),
        F.zip_with(a["dense"], b["dense"], lambda x, y: (x + y).bitwiseAND(_long(_DENSE))).alias("dense"),
        F.zip_with(a["counts"], b["counts"], lambda x, y: (x + y).bitwiseAND(_long(_LANES))).alias("counts"))


def removed(a: Column, b: Column) -> Column:
    """Fingerprint of ``a`` without the pieces of ``b``, which must be among them."""
    return F.struct(
        (a["n"] - b["n"]).bitwiseAND(_long(_DENSE)).alias("n"),
        F.zip_with(a["dense"], b["dense"], lambda x, y: (x - y).bitwiseAND(_long(_DENSE))).alias("dense"),
        F.zip_with(a["counts"], b["counts"],
                   lambda x, y: (x + _long(_GUARDS) - y).bitwiseAND(_long(_LANES))).alias("counts"))


def as_text(fp: Column) -> Column:
    """Lowercase hex of all lanes; equal exactly for equal fingerprints."""
    def digits(values: Column, width: int) -> Column:
        return F.array_join(F.transform(values, lambda v: F.lpad(F.lower(F.hex(v)), width, "0")), "")

    width = -(-(SPACING * (PER_LONG - 1) + LANE_BITS) // 4)
    return F.concat(digits(F.array(fp["n"]), 8), digits(fp["dense"], 8), digits(fp["counts"], width))


def _signs(fp: Column) -> Column:
    """Per counting lane: the sum of its pieces' signs."""
    half = F.shiftright(fp["n"], 1)

    def centred(lane: Column) -> Column:
        off = (lane - half).bitwiseAND(_long((1 << LANE_BITS) - 1))
        signed = F.when(off >= 1 << (LANE_BITS - 1), off - (1 << LANE_BITS)).otherwise(off)
        return (signed * 2 - (fp["n"] - half * 2)).cast("double")

    return F.flatten(F.transform(fp["counts"], lambda c: F.array(*[
        centred(F.shiftright(c, SPACING * i).bitwiseAND(_long((1 << LANE_BITS) - 1))) for i in range(PER_LONG)])))


def likeness(a: Column, b: Column) -> Column:
    """Estimated shared part of two multisets: 1 for equal fingerprints, about 0 for unrelated ones."""
    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)

    def estimate(x: Column, y: Column) -> Column:
        norms = total(F.transform(x, lambda v: v * v)) + total(F.transform(y, lambda v: v * v))
        shared = total(F.zip_with(x, y, lambda v, w: v * w)) * 2
        return F.when(norms == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), shared / norms)))

    unequal = _let(_signs(a), lambda x: _let(_signs(b), lambda y: estimate(x, y)))
    return F.when(a == b, F.lit(1.0)).otherwise(unequal)


def _succession(rows: DataFrame) -> DataFrame:
    """``key, id, n_chars, copies, before_key, before_chars``: each distinct row with the one that it follows.

    Only keys and lengths are sorted. Within a range the row before is a lag;
    a range's first row follows the last one of the range before, and the very
    first follows the very last.
    """
    spark = rows.sparkSession
    order = [F.col("id").desc_nulls_last(), F.col("key")]
    keys = rows.groupBy("id", "key").agg(F.count(F.lit(1)).alias("copies"), F.max("n_chars").alias("n_chars"))
    keys = in_ranges(keys, order, work_folder(spark, "fingerprint-order"))
    inside = Window.partitionBy("part").orderBy(*order)
    me = F.struct("key", "n_chars")
    keys = keys.withColumn("before", F.lag(me).over(inside)).withColumn("last", F.lead("key").over(inside).isNull())
    # One row per range: a table of the session's number of partitions at most.
    lasts = keys.where("last").select("part", me.alias("me"))
    ranges = Window.partitionBy(F.lit(0)).orderBy("part")
    whole = ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    borders = lasts.select("part", F.coalesce(F.lag("me").over(ranges), F.last("me").over(whole)).alias("carried"))
    linked = keys.join(F.broadcast(borders), "part").withColumn("before", F.coalesce("before", "carried"))
    return written(linked.select("key", "id", "n_chars", "copies", F.col("before.key").alias("before_key"),
                                 F.col("before.n_chars").alias("before_chars")), "fingerprint-links")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row.

    The edited text has its last floor(n_chars / 2) code points replaced by
    the first as many of the next document. Its fingerprint shares the pieces
    before the cut with the text's: only the pieces from the cut on are hashed
    again and added.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "id", "text", F.concat_ws(":", F.sha2("text", 256), F.col("id").cast("string")).alias("key"),
        F.length("text").cast("long").alias("n_chars"))
    links = _succession(rows)
    most = links.agg(F.max("copies")).first()[0] or 0

    # Key and text alone, so that both sides of the join below read one shuffle.
    distinct = rows.groupBy("key").agg(F.first("text").alias("text")).join(links, "key")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    given = distinct.select(
        F.col("before_key").alias("key"),
        F.substr("text", F.lit(1), F.floor(F.col("before_chars") / 2).cast("int")).alias("insert"),
        fingerprint(F.col("text")).alias("next"))
    pairs = distinct.select("key", "id", "text", "n_chars", "copies").join(given, "key")

    # All but the last of a row's copies are followed by the row itself.
    own = F.struct(F.substr("text", F.lit(1), half).alias("insert"), F.lit(None).cast(given.schema["next"].dataType).alias(
        "next"), (F.col("copies") - 1).alias("times"))
    other = F.struct("insert", "next", F.lit(1).cast("long").alias("times"))
    pairs = pairs.withColumn("e", F.explode(F.filter(F.array(other, own), lambda e: e["times"] > 0))).select(
        "key", "id", "text", "n_chars", "e.*")

    kept = pairs.withColumn("kept", pieces(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half)))
    kept = kept.withColumn("head", F.slice("kept", 1, F.greatest(F.size("kept") - 1, F.lit(0)))).withColumn(
        "cut", F.coalesce(F.try_element_at("kept", F.lit(-1)), F.lit("")))
    kept = kept.withColumn("head_text", F.array_join("head", "")).withColumn("head_fp", fold(F.col("head")))
    tail = F.substr("text", F.length("head_text") + 1, F.col("n_chars").cast("int"))
    both = kept.select(
        "key", "id", "n_chars", "times", "next", F.sha2(F.concat("head_text", "cut", "insert"), 256).alias("edited_sha256"),
        "head_fp", fingerprint(tail).alias("tail_fp"), fingerprint(F.concat("cut", "insert")).alias("new_fp"))
    both = both.select("key", "id", "n_chars", "times", "edited_sha256", "next",
                       added(F.col("head_fp"), F.col("tail_fp")).alias("fp"),
                       added(F.col("head_fp"), F.col("new_fp")).alias("edited"))
    out = both.select(
        "key", F.col("id").alias("doc_id"), "n_chars", "times", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited")).alias("near_edited"),
        likeness(F.col("fp"), F.coalesce("next", "fp")).alias("near_next"))
    return _repeated(out, most)


def _repeated(out: DataFrame, most: int) -> DataFrame:
    """Each row ``times`` times, in blocks; where a row has many copies, its blocks go to several tasks."""
    out = out.withColumn("block", F.explode(F.sequence(_long(0), F.floor((F.col("times") - 1) / COPIES))))
    if most > COPIES:
        out = out.repartition("key", "block")
    size = F.least(_long(COPIES), F.col("times") - F.col("block") * COPIES)
    return out.withColumn("copy", F.explode(F.sequence(_long(1), size))).drop("key", "times", "block", "copy")
