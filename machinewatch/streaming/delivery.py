"""Size-or-time delivery (S13): files of bounded bytes, and a manifest that says which of them count.

A trigger is the time bound; the size bound is measured, not guessed: rows are
laid on one line of bytes per arrival hour (prefix sums over ranges), the line
is cut into cells, and a cell is a file. Each delivery and each compaction
writes a folder of its own, then swaps the manifest: a new version is written
aside and renamed into place, which succeeds for one writer only. Readers take
the newest version, so a writer that dies leaves files that nobody reads, and
never a row lost or doubled. A replayed micro-batch finds its id in the manifest.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from machinewatch.operators.ranges import in_ranges, running_offsets
from machinewatch.session import scratch_path

#: Bytes of a file before compression.
MAX_BYTES = 5 * 1000 * 1000
HOURS = ("year", "month", "day", "hour")
#: Attempts to swap the manifest when other writers are faster.
ATTEMPTS = 20


# --- manifest ------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Manifest:
    """Live folders by name, each with the micro-batches it holds: ``{"folder": [batch ids]}``."""

    version: int
    live: dict[str, list[int]]


class Conflict(Exception):
    """Another writer took this version of the manifest."""


def _fs(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(conf)


def _versions(spark: SparkSession, root: str) -> list[int]:
    folder, fs = _fs(spark, os.path.join(root, "manifest"))
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def read_manifest(spark: SparkSession, root: str) -> Manifest:
    """The newest version; version 0 without any file is an empty delivery."""
    found = _versions(spark, root)
    if not found:
        return Manifest(0, {})
    path, fs = _fs(spark, os.path.join(root, "manifest", f"{found[-1]:012d}.json"))
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(found[-1], json.loads(text))


def swap_manifest(spark: SparkSession, root: str, old: Manifest, live: dict[str, list[int]]) -> None:
    """Put ``live`` in place of ``old``, or raise ``Conflict`` if ``old`` is no longer the newest."""
    jvm = spark.sparkContext._jvm
    target, fs = _fs(spark, os.path.join(root, "manifest", f"{old.version + 1:012d}.json"))
    aside, _ = _fs(spark, os.path.join(root, "manifest", f".{uuid.uuid4().hex}"))
    out = fs.create(aside, False)
    try:
        out.write(bytearray(json.dumps(live, sort_keys=True).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    # Rename without overwrite: the second of two writers fails.
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(aside, target, options)
    except Exception as error:
        fs.delete(aside, False)
        if fs.exists(target):
            raise Conflict(f"manifest version {old.version + 1} is taken") from error
        raise


def _commit(spark: SparkSession, root: str, change: Callable[[dict[str, list[int]]], dict[str, list[int]] | None]) -> bool:
    """Swap in ``change(live)``, again on a newer version after a conflict; False if the change gives None."""
    for _ in range(ATTEMPTS):
        old = read_manifest(spark, root)
        live = change(dict(old.live))
        if live is None:
            return False
        try:
            swap_manifest(spark, root, old, live)
            return True
        except Conflict:
            continue
    raise Conflict(f"no manifest version was free in {ATTEMPTS} attempts")


# --- files of bounded bytes ----------------------------------------------------------------------

def write_bounded(rows: DataFrame, path: str, work: str, keys: tuple[str, ...] = HOURS, max_bytes: int = MAX_BYTES) -> None:
    """``rows`` (``value`` text and ``keys``) as gzip lines under ``key=/.../file=n/``, one file per folder.

    A file holds the rows that begin in one cell of its key's line of bytes.
    Cells are as long as a file less the longest row that may begin in one, so
    no file exceeds ``max_bytes``; rows of over half a file, which would make
    cells small, have files of their own (one row over ``max_bytes`` is a
    longer file, as a row is never cut).
    """
    size = F.octet_length("value").cast("long") + 1
    sized = rows.select(*keys, "value", size.alias("bytes"), F.xxhash64("value").alias("h"))
    small = F.col("bytes") <= max_bytes // 2
    ranged = in_ranges(sized, [*[F.col(k) for k in keys], F.col("h")], work)
    longest = ranged.filter(small).agg(F.max("bytes")).first()[0] or 0
    cell = max_bytes - longest
    own = F.when(small, F.col("bytes")).otherwise(F.lit(0))
    inside = _before(own, [*keys, "part"])
    placed = ranged.withColumn("inside", inside).join(running_offsets(ranged, own, list(keys)), [*keys, "part"])
    at = F.floor((F.col("offset") + F.col("inside")) / F.lit(cell)).cast("string")
    named = placed.withColumn("file", F.when(small, at).otherwise(
        F.concat(F.lit("long-"), F.col("part").cast("string"), F.lit("-"), _number([*keys, "part"]).cast("string"))))
    (named.repartition(*keys, "file").select(*keys, "file", "value").write.partitionBy(*keys, "file")
        .option("compression", "gzip").text(path))


def _before(value: Column, keys: list[str]) -> Column:
    line = Window.partitionBy(*keys).orderBy("h", "value").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(line), F.lit(0))


def _number(keys: list[str]) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy("h", "value"))


def _new_folder(kind: str) -> str:
    return f"{kind}-{uuid.uuid4().hex}"


def deliver(batch: DataFrame, batch_id: int, root: str, max_bytes: int = MAX_BYTES) -> bool:
    """Write a micro-batch (``value`` and hour keys) and make it live; False if it is already."""
    spark = batch.sparkSession

    def known(live: dict[str, list[int]]) -> bool:
        return any(batch_id in ids for ids in live.values())

    if known(read_manifest(spark, root).live):
        return False
    folder = _new_folder("batch")
    write_bounded(batch, os.path.join(root, "data", folder), scratch_path(spark, f"delivery-{folder}"), max_bytes=max_bytes)
    return _commit(spark, root, lambda live: None if known(live) else {**live, folder: [batch_id]})


def read_folders(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """``value`` and the hour keys of some folders, each scanned by itself with its own partitions."""
    schema = "value string, year int, month int, day int, hour int, file string"
    out = spark.createDataFrame([], schema)
    for folder in folders:
        out = out.unionByName(spark.read.schema(schema).text(os.path.join(root, "data", folder)))
    return out.drop("file")


def read_delivered(spark: SparkSession, root: str) -> DataFrame:
    """``value`` and the hour keys of all live folders."""
    return read_folders(spark, root, sorted(read_manifest(spark, root).live))


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """``file, bytes``: text bytes (before compression, line ends included) of each live file."""
    out = spark.createDataFrame([], "file string, bytes bigint")
    for folder in sorted(read_manifest(spark, root).live):
        lines = spark.read.option("recursiveFileLookup", "true").text(os.path.join(root, "data", folder))
        out = out.unionByName(lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.sum(F.octet_length("value").cast("long") + 1).alias("bytes")))
    return out


def compact(spark: SparkSession, root: str, max_bytes: int = MAX_BYTES) -> bool:
    """All live folders as one, with files as full as the bound allows; False if there is nothing to gain.

    Folders delivered meanwhile stay beside the new one. Another compaction of
    the same folders makes this one void: its folder is then never read.
    """
    merged = read_manifest(spark, root).live
    if len(merged) < 2:
        return False
    folder = _new_folder("compacted")
    rows = read_folders(spark, root, sorted(merged))
    write_bounded(rows, os.path.join(root, "data", folder), scratch_path(spark, f"delivery-{folder}"), max_bytes=max_bytes)
    ids = sorted(i for batch in merged.values() for i in batch)

    def replaced(live: dict[str, list[int]]) -> dict[str, list[int]] | None:
        if not set(merged) <= set(live):
            return None
        return {**{f: b for f, b in live.items() if f not in merged}, folder: ids}

    return _commit(spark, root, replaced)


def remove_dead(spark: SparkSession, root: str, folders: list[str]) -> None:
    """Delete folders that a compaction has replaced; a live one is refused."""
    alive = set(folders) & set(read_manifest(spark, root).live)
    if alive:
        raise ValueError(f"still live: {sorted(alive)}")
    for folder in folders:
        path, fs = _fs(spark, os.path.join(root, "data", folder))
        fs.delete(path, True)


def start_delivery(stream: DataFrame, root: str, available_now: bool = True, max_bytes: int = MAX_BYTES) -> StreamingQuery:
    """Rows as JSON lines by arrival hour, at the latest every 60 seconds, in files of at most ``max_bytes``."""
    arrival = F.current_timestamp()
    lines = stream.select(F.to_json(F.struct(*stream.columns)).alias("value"), F.year(arrival).alias("year"),
                          F.month(arrival).alias("month"), F.dayofmonth(arrival).alias("day"), F.hour(arrival).alias("hour"))

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            deliver(batch, batch_id, root, max_bytes)

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(root, "checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="60 seconds")
    return writer.start()
