"""Raw reading sources: JSON lake (S1, S2), concatenated JSON (S3), stream payloads (S10),
schema discovery (S18), and the raw-text fixtures derived from ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from machinewatch.schema import RAW_STRING_SCHEMA, READING_SCHEMA

LAKE_KEYS = ("year", "month", "day", "hour")

# ---------------------------------------------------------------------------
# Readers
# ---------------------------------------------------------------------------


def read_raw(spark: SparkSession, path: str, schema: T.StructType = READING_SCHEMA,
             recursive: bool = False) -> DataFrame:
    """JSON-lines lake scan with an explicit schema.

    Hive folders ``year=/month=/day=/hour=`` are discovered as partition
    columns (so filters on them prune folders); ``.gz`` files are read by
    codec, one task per file since gzip is not splittable.
    ``recursive=True`` is for unpartitioned trees only (it disables
    partition discovery).
    """
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.json(path)


def read_raw_text(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines as text (``raw`` column) for validation that must see absent keys."""
    return spark.read.text(path).withColumnRenamed("value", "raw")


def split_concatenated(text: Column) -> Column:
    """S3: split ``{..}{..}`` runs (flat objects, no nested braces) into one object each."""
    return F.split(F.regexp_replace(text, r"\}\s*\{", "}\n{"), "\n")


def read_concat_json(spark: SparkSession, path: str, schema: T.StructType = READING_SCHEMA) -> DataFrame:
    """S3: files holding several JSON objects per line without separator."""
    lines = spark.read.text(path)
    objs = lines.select(F.explode(split_concatenated(F.col("value"))).alias("raw"))
    objs = objs.filter(F.length(F.trim("raw")) > 0)
    return objs.select(F.from_json("raw", schema).alias("r")).select("r.*")


def decode_payload(records: DataFrame, data_col: str = "data", body_col: str = "body") -> DataFrame:
    """base64 -> UTF-8 text, falling back to the plain ``body``; adds ``raw``.

    Bad base64 gives NULL (``try_to_binary``) instead of failing the batch.
    """
    decoded = F.try_to_binary(F.col(data_col), F.lit("base64"))
    text = F.coalesce(F.decode(decoded, "utf-8"), F.col(body_col))
    return records.withColumn("raw", text)


def parse_raw(df: DataFrame, raw_col: str = "raw", schema: T.StructType = RAW_STRING_SCHEMA,
              whole_col: str | None = None) -> DataFrame:
    """Parse ``raw`` into string-typed fields (so bad values are kept for routing).

    ``whole_col`` is true where the text is one object that was read to its end
    without an error, by rules that ``json_object_keys`` shares: there a value
    that is not null shows that its key is present.
    """
    if not whole_col:
        return df.withColumn("_r", F.from_json(F.col(raw_col), schema)).select("*", "_r.*").drop("_r")
    parsed = F.from_json(F.col(raw_col), T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())]),
                         {"columnNameOfCorruptRecord": "_corrupt", "allowNonNumericNumbers": "false"})
    whole = F.coalesce(F.col(raw_col).startswith("{") & F.col("_corrupt").isNull(), F.lit(False))
    return df.withColumn("_r", parsed).select("*", "_r.*").withColumn(whole_col, whole).drop("_r", "_corrupt")


def crawl_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """Infer the lake's schema (column, type, is_partition) like a crawler would.

    Spark samples the files; only the inferred schema (a handful of fields)
    reaches the driver.
    """
    inferred = spark.read.option("samplingRatio", sampling_ratio).json(path)
    rows = [(f.name, f.dataType.simpleString(), f.name in LAKE_KEYS) for f in inferred.schema.fields]
    return spark.createDataFrame(rows, "column_name string, data_type string, is_partition boolean")


def register_lake_table(spark: SparkSession, path: str, table: str = "sensor_data_raw") -> None:
    """Catalog table over the partitioned lake, with the schema found in its files.

    An existing table of that name is an error; nothing is dropped.
    """
    found = spark.read.json(path).schema
    keys = [f.name for f in found.fields if f.name in LAKE_KEYS]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING json PARTITIONED BY ({', '.join(keys)}) "
              f"LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {table}")


# ---------------------------------------------------------------------------
# Raw fixtures derived from the readings (FIXTURES.md section 3)
# ---------------------------------------------------------------------------
# Fixed defect rules of ``raw_bad``: temperature "bad" every 101st event, no
# machine_id every 103rd, null timestamp every 107th, no timestamp every 109th.
BAD_TEMPERATURE_EVERY = 101
NO_MACHINE_EVERY = 103
NULL_TIMESTAMP_EVERY = 107
NO_TIMESTAMP_EVERY = 109
BODY_EVERY = 10


def _kv(name: str, value_text: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), value_text)


def _num(c: str) -> Column:
    return F.when(F.col(c).isNotNull(), _kv(c, F.col(c).cast("string")))


def raw_json(readings: DataFrame) -> DataFrame:
    """``raw`` = JSON of the five reading fields; NULL fields are absent."""
    fields = F.struct("machine_id", "timestamp", "temperature", "vibration", "pressure")
    return readings.select("event_id", "event_timestamp", F.to_json(fields).alias("raw"))


def raw_bad(readings: DataFrame) -> DataFrame:
    """``raw_json`` with the defect rules above applied."""
    eid = F.col("event_id")
    machine = F.when(eid % NO_MACHINE_EVERY != 0,
                     _kv("machine_id", F.concat(F.lit('"'), F.col("machine_id"), F.lit('"'))))
    ts = (F.when(eid % NO_TIMESTAMP_EVERY == 0, F.lit(None).cast("string"))
          .when(eid % NULL_TIMESTAMP_EVERY == 0, _kv("timestamp", F.lit("null")))
          .otherwise(_kv("timestamp", F.col("timestamp").cast("string"))))
    temp = F.when(eid % BAD_TEMPERATURE_EVERY == 0, _kv("temperature", F.lit('"bad"'))).otherwise(
        _num("temperature"))
    body = F.concat_ws(",", machine, ts, temp, _num("vibration"), _num("pressure"))
    return readings.select("event_id", "event_timestamp",
                           F.concat(F.lit("{"), body, F.lit("}")).alias("raw"))


def stream_records(raw: DataFrame) -> DataFrame:
    """``raw_base64``: payload as base64 ``data``; every 10th event as plain ``body``."""
    use_body = F.col("event_id") % BODY_EVERY == 0
    return raw.select(
        "event_id", "event_timestamp",
        F.when(~use_body, F.base64(F.encode(F.col("raw"), "utf-8"))).alias("data"),
        F.when(use_body, F.col("raw")).alias("body"),
    )
