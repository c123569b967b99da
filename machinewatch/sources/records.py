"""Record boundaries in concatenated JSON (S3): objects without separators, in files without newlines.

A closing brace is the only place where an object can end, so the files are
read as text with ``}`` as the line separator: Spark cuts even one long line
into splits, and each split into fragments. Whether a fragment's last brace
ends an object depends on all that comes before it, but only through two
numbers that add up over fragments:

* unescaped quotes, modulo 2: is the fragment inside a string when it begins?
* braces outside strings: how deep is it nested? (A stray closing brace at
  depth 0 stays at depth 0, which takes a running minimum as well.)

Both are prefix sums over (file, split, fragment): within each split by a
window, over splits through one row per split. An object is then the fragments
between two returns to depth 0, put together again by its number.

Defined results: white space and commas between objects belong to none; text
between objects that is neither goes in front of the next one, and text after
the last one, or an object that is never closed, is a record of its own, so that
the parser rejects it and nothing is lost. A backslash outside a string escapes
as well. Gzip files are one split each, as the codec is.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from machinewatch.schema import READING_SCHEMA
from machinewatch.session import scratch_path

_SPLIT = ["file", "split"]


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """``file, split, row, bytes, text``: the text between closing braces, in file order; ``bytes`` is the file's size."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "}").text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("split"), F.monotonically_increasing_id().alias("row"),
        meta["file_size"].alias("bytes"), F.col("value").alias("text"))


def _scanned(fragments: DataFrame) -> DataFrame:
    """Quotes and opening braces of each fragment, for both ways it can begin."""
    plain = F.regexp_replace("text", r"(?s)\\.", "")
    parts = F.split(plain, '"')

    def opening(parity: int) -> Column:
        return F.aggregate(F.filter(parts, lambda p, i: i % 2 == parity), F.lit(0).cast("long"),
                           lambda n, p: n + F.length(p) - F.length(F.replace(p, F.lit("{"), F.lit(""))))

    return fragments.select("file", "split", "row", "bytes", "text", (F.size(parts) - 1).cast("long").alias("quotes"),
                            opening(0).alias("open_out"), opening(1).alias("open_in"))


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, record, raw``: every object of the files under ``path``, in file order by ``record``."""
    work = scratch_path(spark, f"records-{uuid.uuid4().hex}")
    _scanned(_fragments(spark, path)).write.parquet(work)
    rows = spark.read.parquet(work)
    upto = Window.partitionBy(*_SPLIT).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*_SPLIT).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)

    # Inside a string at the start and at the end of a fragment? And has the file's last fragment a brace?
    length = F.octet_length("text").cast("long") + 1
    per_split = rows.groupBy(*_SPLIT).agg(
        F.sum("quotes").alias("quotes"), F.sum(length).alias("length"), F.max("bytes").alias("size"), F.max("row").alias("last"))
    in_file = Window.partitionBy("file")
    earlier = in_file.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    unclosed = (F.col("split") == F.max("split").over(in_file)) & (F.sum("length").over(in_file) > F.col("size"))
    rows = rows.join(per_split.select(
        *_SPLIT, F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("_base"), F.when(unclosed, F.col("last")).alias("_tail")), _SPLIT)
    start = (F.col("_base") + F.coalesce(F.sum("quotes").over(before), F.lit(0))) % 2
    rows = rows.withColumn("inside", start).withColumn("ends_inside", (F.col("inside") + F.col("quotes")) % 2).withColumn(
        "tail", F.coalesce(F.col("row") == F.col("_tail"), F.lit(False))).drop("_base", "_tail")

    opened = F.when(F.col("inside") == 0, F.col("open_out")).otherwise(F.col("open_in"))
    closing = ~F.col("tail") & (F.col("ends_inside") == 0)
    rows = rows.withColumn("closing", closing).withColumn("step", opened - closing.cast("long"))

    # Depth after each fragment; what would fall below 0 is a stray brace and stays at 0.
    rows = rows.withColumn("sum", F.sum("step").over(upto)).withColumn("low", F.min("sum").over(upto))
    ends = rows.groupBy(*_SPLIT).agg(F.sum("step").alias("_sum"), F.min("sum").alias("_low"))
    ends = ends.withColumn("_base", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).withColumn(
        "_floor", F.col("_base") + F.col("_low"))
    ends = ends.select(*_SPLIT, "_base", F.least(F.lit(0), F.coalesce(F.min("_floor").over(earlier), F.lit(0))).alias("_least"))
    rows = rows.join(ends, _SPLIT).withColumn(
        "depth", F.col("_base") + F.col("sum") - F.least("_least", F.col("_base") + F.col("low"))).drop("_base", "_least")

    # An object's number is how many have ended before it.
    rows = rows.withColumn("ended", (F.col("closing") & (F.col("depth") == 0)).cast("long"))
    ended = rows.groupBy(*_SPLIT).agg(F.sum("ended").alias("_sum")).select(
        *_SPLIT, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    rows = rows.join(ended, _SPLIT).withColumn(
        "record", F.col("_base") + F.coalesce(F.sum("ended").over(before), F.lit(0)))
    piece = F.when(F.col("tail"), F.col("text")).otherwise(F.concat("text", F.lit("}")))
    whole = rows.select("file", "record", F.struct("split", "row", piece.alias("text")).alias("p")).groupBy("file", "record").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["text"]), "").alias("raw"))
    trimmed = F.regexp_replace(F.regexp_replace("raw", r"^[\s,]+", ""), r"[\s,]+$", "")
    return whole.select("file", "record", trimmed.alias("raw")).filter(F.length("raw") > 0)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType = READING_SCHEMA) -> DataFrame:
    """The objects parsed with ``schema``; a record that is no object gives nulls, as ``from_json`` does."""
    return json_records(spark, path).select(F.from_json("raw", schema).alias("r")).select("r.*")
