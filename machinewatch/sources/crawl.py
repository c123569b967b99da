"""Schema discovery with drift (S18): types counted per folder, and only new or changed folders read.

Per folder, column and JSON type the crawl stores how many records there are.
These counts add up, so the schema of the whole lake, or of any span of it,
comes from the store alone, with the folders where a column first and last
had a type. A crawl compares the lake's listing with the folders that it knows
(number of files, bytes, newest change) and reads the rest.

Defined results: numbers with a fraction are ``double``, nulls are no type; a
column of whole and fractional numbers is ``double``, of any other mixture
``string``; a column that only ever was null is ``string``. A record that is no
JSON object is counted under the column ``_corrupt``. A folder that is read
again replaces its earlier counts.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from machinewatch.sources.raw import LAKE_KEYS

CORRUPT = "_corrupt"
_TYPES = "year int, month int, day int, hour int, column_name string, data_type string, records bigint, crawl int"
_FOLDERS = "folder string, year int, month int, day int, hour int, files bigint, bytes bigint, newest bigint, crawl int"


def folder_types(lines: DataFrame) -> DataFrame:
    """``year, month, day, hour, column_name, data_type, records`` of JSON lines (``value``); summed per task first."""
    fields = F.from_json("value", "map<string,variant>")
    broken = F.array(F.struct(F.lit(CORRUPT).alias("column_name"), F.lit(None).cast("variant").alias("v")))
    entries = F.when(fields.isNull(), broken).otherwise(F.transform(F.map_entries(fields), lambda e: F.struct(
        e["key"].alias("column_name"), e["value"].alias("v"))))
    each = lines.select(*LAKE_KEYS, F.inline(entries))
    kind = F.regexp_replace(F.lower(F.coalesce(F.schema_of_variant("v"), F.lit("void"))), r"decimal\(\d+,\s*\d+\)", "double")
    return each.groupBy(*LAKE_KEYS, "column_name", F.replace(kind, F.lit("object<"), F.lit("struct<")).alias("data_type")).agg(
        F.count(F.lit(1)).alias("records"))


def list_folders(spark: SparkSession, path: str) -> dict[str, tuple[int, int, int]]:
    """Per leaf folder ``year=/month=/day=/hour=``: files, bytes and newest change; names only, no data is read."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(path, *[f"{k}=*" for k in LAKE_KEYS], "[!._]*"))
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[str, tuple[int, int, int]] = {}
    for status in fs.globStatus(pattern) or []:
        parts, parent = [], status.getPath().getParent()
        for _ in LAKE_KEYS:
            parts.append(parent.getName())
            parent = parent.getParent()
        folder = "/".join(reversed(parts))
        files, size, newest = found.get(folder, (0, 0, 0))
        found[folder] = files + 1, size + status.getLen(), max(newest, status.getModificationTime())
    return found


def _keys_of(folder: str) -> tuple[int, ...]:
    return tuple(int(part.split("=", 1)[1]) for part in folder.split("/"))


def _known(spark: SparkSession, store: str) -> DataFrame:
    """The latest crawl's row of each folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(store, "folders"))
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _FOLDERS)
    rows = spark.read.schema(_FOLDERS).parquet(os.path.join(store, "folders"))
    values = [c for c in rows.columns if c != "folder"]
    return rows.groupBy("folder").agg(F.max_by(F.struct(*values), "crawl").alias("v")).select("folder", "v.*")


def crawl(spark: SparkSession, path: str, store: str) -> list[str]:
    """Bring ``store`` up to date with the lake at ``path``; the folders that were read.

    The folders are noted last: a crawl that dies before is done again.
    """
    known = {r["folder"]: (r["files"], r["bytes"], r["newest"], r["crawl"]) for r in _known(spark, store).collect()}
    listing = list_folders(spark, path)
    fresh = sorted(f for f, state in listing.items() if f not in known or known[f][:3] != state)
    if not fresh:
        return []
    run = max((k[3] for k in known.values()), default=-1) + 1
    lines = spark.read.option("basePath", path).text([os.path.join(path, f) for f in fresh])
    folder_types(lines).write.mode("overwrite").parquet(os.path.join(store, "types", f"crawl={run}"))
    rows = [(f, *_keys_of(f), *listing[f]) for f in fresh]
    spark.createDataFrame(rows, _FOLDERS.rsplit(",", 1)[0]).coalesce(1).write.mode("overwrite").parquet(
        os.path.join(store, "folders", f"crawl={run}"))
    return fresh


def stored_types(spark: SparkSession, store: str) -> DataFrame:
    """Counts per folder, column and type, from each folder's latest crawl."""
    types = spark.read.schema(_TYPES).parquet(os.path.join(store, "types"))
    return types.join(_known(spark, store).select(*LAKE_KEYS, "crawl"), [*LAKE_KEYS, "crawl"]).drop("crawl")


def lake_schema(spark: SparkSession, store: str) -> DataFrame:
    """One row per column: ``column_name, data_type, types, records, first_seen, last_seen, changed_type, appeared_late,
    vanished``.

    ``first_seen`` and ``last_seen`` are the hours of the folders; a column is
    late or vanished if the lake has folders before or after them.
    """
    hour = F.make_timestamp_ntz("year", "month", "day", "hour", F.lit(0), F.lit(0))
    rows = stored_types(spark, store).withColumn("at", hour)
    typed = F.when(F.col("data_type") != "void", F.col("data_type"))
    merged = rows.groupBy("column_name").agg(
        F.array_sort(F.collect_set(typed)).alias("kinds"), F.sum("records").alias("records"),
        F.min("at").alias("first_seen"), F.max("at").alias("last_seen"))
    kinds = F.col("kinds")
    numbers = F.size(F.array_except(kinds, F.array(F.lit("bigint"), F.lit("double")))) == 0
    widest = F.when(F.size(kinds) == 0, "string").when(F.size(kinds) == 1, kinds[0]).when(numbers, "double").otherwise("string")
    # One row per column of the lake.
    whole = Window.partitionBy(F.lit(0))
    return merged.select(
        "column_name", widest.alias("data_type"), F.array_join(kinds, ",").alias("types"), "records", "first_seen", "last_seen",
        (F.size(kinds) > 1).alias("changed_type"), (F.col("first_seen") > F.min("first_seen").over(whole)).alias("appeared_late"),
        (F.col("last_seen") < F.max("last_seen").over(whole)).alias("vanished"))


def schema_ddl(spark: SparkSession, store: str) -> str:
    """The lake's columns and keys as DDL, for readers and catalog tables; records that are no objects are left out."""
    columns = [(r["column_name"], r["data_type"]) for r in lake_schema(spark, store).orderBy("column_name").collect()
               if r["column_name"] not in (CORRUPT, *LAKE_KEYS)]
    return ", ".join(f"`{name.replace('`', '``')}` {kind}" for name, kind in [*columns, *((k, "int") for k in LAKE_KEYS)])
