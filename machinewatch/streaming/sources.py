"""Stream sources (S9) and the arrival of stream files.

Production reads a message bus through a connector when one is on the
classpath; tests and the registered queries read a folder of JSON-lines files
with the file source.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_stream_text(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw JSON lines as a streaming ``raw`` column (file source)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).withColumnRenamed("value", "raw")


def read_stream_bus(spark: SparkSession, servers: str, topic: str,
                    max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S9 with a Kafka-compatible bus, from the latest offset.

    A trigger takes all that has arrived; a limit per trigger is the caller's
    choice, as a backlog beyond the bus's retention would be lost.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", "latest"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load().select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("raw"),
                                F.col("timestamp").alias("arrival_time"))


def run_arrivals(raw: DataFrame, root: str, batch_col: str, start: Callable[[DataFrame], StreamingQuery]) -> int:
    """Let the lines of each ``batch_col`` value arrive in turn, and run the stream until it has taken them.

    The input is dealt out once, by one partitioned write. Each batch then
    arrives as many files (one per staged split), and ``start(stream)`` is
    run over the watched folder until all of them are processed: one
    micro-batch per arrival, restarted from its checkpoint every time. Only
    the list of batch values reaches the driver. Returns their number.
    """
    spark = raw.sparkSession
    staged, watched = os.path.join(root, "staged"), os.path.join(root, "input")
    parts = F.pmod(F.xxhash64("raw"), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    raw.select(F.col(batch_col).cast("string").alias("arrival"), "raw").repartition(F.col("arrival"), parts).write.mode(
        "overwrite").partitionBy("arrival").parquet(staged)
    table = spark.read.schema("raw string, arrival string").parquet(staged)
    values = [r[0] for r in table.select("arrival").distinct().orderBy("arrival").collect()]
    for value in values:
        table.filter(F.col("arrival") == F.lit(value)).select("raw").write.mode("append").text(watched)
        start(read_stream_text(spark, watched)).awaitTermination()
    return len(values)
