"""Stream transform (ST1, ST4, S11, S12, S14, S23): decode, enrich, validate,
per-batch statistics, and idempotent fan-out to the sinks.

``foreachBatch`` is at-least-once, so every sink writes the batch into its
own ``batch_id=N`` folder and overwrites that: a replayed batch replaces its
own output instead of appending duplicates.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F
from pyspark.sql import types as T

from machinewatch.operators.enrich import enrich_stream
from machinewatch.operators.quality import dead_letter_rows, split_valid, validate_readings
from machinewatch.operators.stats import attach_batch_stats, latest_with_stats
from machinewatch.schema import RAW_STRING_SCHEMA, REQUIRED_FIELDS
from machinewatch.sinks.files import session_conf
from machinewatch.sinks.messages import republish_keyed
from machinewatch.sources.raw import decode_payload, parse_raw
from machinewatch.streaming.dedupe import STATE_STORE, drop_redelivered

# In the transform path an absent timestamp is filled, so it is not required.
TRANSFORM_REQUIRED = tuple(f for f in REQUIRED_FIELDS if f != "timestamp")


@dataclass(frozen=True)
class TransformPaths:
    root: str

    def __getattr__(self, name: str) -> str:  # delivered, keyed, errors, batch_log, checkpoint
        return os.path.join(self.root, name)


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Replace the batch's own folder. Written as such, its rows need no sort by a column that is the same in all of them."""
    df.drop("batch_id").write.mode("overwrite").format(fmt).save(os.path.join(path, f"batch_id={batch_id}"))


def together(spark: SparkSession, *jobs: Callable[[], None]) -> None:
    """Run independent jobs of one batch at the same time; all have ended when this returns or raises."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            done.result()


def transform_records(raw: DataFrame) -> DataFrame:
    """Per-row part of ST1 (works on batch and streaming frames): parse, enrich, validate."""
    # A sound record is parsed once; its keys and its id are looked up in the text again only where that leaves a question.
    own_id = "event_id" not in raw.columns  # a record may carry a message id as a sixth field
    schema = T.StructType([*RAW_STRING_SCHEMA.fields, *[T.StructField("event_id", T.StringType())] * own_id])
    parsed = parse_raw(raw, schema=schema, whole_col="_whole")
    if own_id:
        text, value = F.col("event_id"), F.col("event_id").try_cast("bigint")
        looked_up = F.get_json_object("raw", "$.event_id").try_cast("bigint")
        twice = F.call_function("locate", F.lit("event_id"), F.col("raw"), F.locate("event_id", "raw") + F.lit(1)) > 0
        open_question = ~F.col("_whole") | (text.isNotNull() & value.isNull()) | twice
        parsed = parsed.withColumn("event_id", F.when(open_question, looked_up).otherwise(value))
    enriched = enrich_stream(parsed, whole_col="_whole")
    return validate_readings(enriched, required=TRANSFORM_REQUIRED, whole_col="_whole").drop("_whole")


def make_batch_writer(paths: TransformPaths, group_cols: tuple[str, ...] = ("machine_id",)):
    """``foreachBatch`` body: statistics on the latest row per group, then the sinks."""

    def write(batch: DataFrame, batch_id: int) -> None:
        started = time.time()
        validated = batch.persist()
        try:
            # One aggregate gives the batch log counts and doubles as the
            # empty-batch check (S11), instead of a separate isEmpty job.
            counts = validated.agg(
                F.count(F.lit(1)).alias("records"),
                F.count_if(F.col("is_valid")).alias("processed_records"),
                F.count_if(~F.col("is_valid")).alias("rejected_records"),
            ).first()
            if counts["records"] == 0:
                return
            valid, _ = split_valid(validated)
            typed = valid.withColumn("event_time", F.timestamp_seconds("timestamp"))
            # Device records have no id; where some do, it only breaks ties in time.
            # Held and computed first, the groups are of known size: few are sent to the records, which stay where they are.
            # A held plan keeps all its shuffle partitions, also empty ones; one part a core is as parallel.
            groups = latest_with_stats(typed, list(group_cols), ts="event_time").coalesce(
                batch.sparkSession.sparkContext.defaultParallelism).persist()
            try:
                groups.write.format("noop").mode("overwrite").save()
                enriched = attach_batch_stats(typed, list(group_cols), ts="event_time", groups=groups)
                # What is published is the enriched record, without the raw text it came from.
                keyed = republish_keyed(enriched.drop("raw", "is_valid", "reject_reason"))
                together(batch.sparkSession, lambda: write_batch(enriched, paths.delivered, batch_id),
                         lambda: write_batch(keyed, paths.keyed, batch_id, "json"),
                         lambda: write_batch(dead_letter_rows(validated), paths.errors, batch_id, "json"))
            finally:
                groups.unpersist()
            log = batch.sparkSession.range(0, 1, 1, 1).select(
                *[F.lit(counts[c]).cast("bigint").alias(c) for c in ("records", "processed_records", "rejected_records")],
                F.lit((time.time() - started) * 1000.0).alias("processing_time_ms"),
                F.current_timestamp().alias("logged_at"))
            write_batch(log, paths.batch_log, batch_id, "json")
        finally:
            validated.unpersist()

    return write


def start_transform(stream: DataFrame, paths: TransformPaths, available_now: bool = True,
                    processing_time: str = "5 seconds", payload: bool = False,
                    redelivered_within: str | None = None) -> StreamingQuery:
    """ST1: ``stream`` carries ``raw`` (or ``data``/``body`` when ``payload``).

    ``redelivered_within`` ("24 hours") takes records that arrive again within
    that time once; without it every delivery counts.
    """
    raw = decode_payload(stream) if payload else stream
    if redelivered_within:
        raw = drop_redelivered(raw, redelivered_within)
    validated = transform_records(raw)
    writer = (validated.writeStream.foreachBatch(make_batch_writer(paths))
              .option("checkpointLocation", paths.checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time)
    with session_conf(stream.sparkSession, STATE_STORE if redelivered_within else {}):
        return writer.start()
