"""Stream scoring (ST2): decode -> validate -> features -> model -> alerts, metrics, dead letters, log.

Every record of a micro-batch is either scored or rejected with a reason: the
log holds both counts. The saved ``PipelineModel`` scores the batch on the
executors (no per-record service call), as does a ``FlatForest`` loaded from it, with less to do per batch. All outputs are written per batch id
with dynamic overwrite, so a replayed batch replaces its own output.
"""

from __future__ import annotations

import os
import time

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from machinewatch.operators.enrich import lenient_features
from machinewatch.operators.forest import FlatForest
from machinewatch.operators.ml import postprocess_prediction, score
from machinewatch.operators.quality import dead_letter_rows, range_warnings, split_valid, validate_readings
from machinewatch.sinks.files import session_conf
from machinewatch.sinks.messages import alert_messages, metrics_long
from machinewatch.sources.raw import decode_payload, parse_raw
from machinewatch.streaming.dedupe import STATE_STORE, drop_redelivered
from machinewatch.streaming.transform import write_batch

SCORE_REQUIRED = ("temperature", "vibration", "pressure")


def validate_records(raw: DataFrame) -> DataFrame:
    """Typed fields with ``is_valid`` and ``reject_reason``; only the sensors are required here."""
    return validate_readings(parse_raw(raw), required=SCORE_REQUIRED)


def score_valid(valid: DataFrame, model: PipelineModel | FlatForest) -> DataFrame:
    """Warnings, features, prediction, label and severity of validated records."""
    return postprocess_prediction(score(model, lenient_features(range_warnings(valid))))


def score_records(raw: DataFrame, model: PipelineModel | FlatForest) -> DataFrame:
    """Per-row part of ST2 on a batch frame: the valid records, scored."""
    return score_valid(split_valid(validate_records(raw))[0], model)


def make_score_writer(root: str, model: PipelineModel | FlatForest):
    """``foreachBatch`` body over validated records."""

    def write(batch: DataFrame, batch_id: int) -> None:
        started = time.time()
        validated = batch.persist()
        try:
            counts = validated.agg(
                F.count(F.lit(1)).alias("records"),
                F.count_if(F.col("is_valid")).alias("scored_records"),
                F.count_if(~F.col("is_valid")).alias("rejected_records"),
            ).first()
            if counts["records"] == 0:
                return
            # A record without a time is taken as read now.
            at = F.coalesce(F.timestamp_seconds("timestamp"), F.current_timestamp()).cast("timestamp_ntz")
            scored = score_valid(split_valid(validated)[0], model).withColumn("event_time", at).persist()
            try:
                # The alerts make the model run; the metrics then know how long that took.
                write_batch(alert_messages(scored, time_col="event_time"), os.path.join(root, "alerts"), batch_id)
                elapsed = (time.time() - started) * 1000.0
                write_batch(metrics_long(scored.withColumn("duration_ms", F.lit(elapsed)), duration_col="duration_ms"),
                            os.path.join(root, "metrics"), batch_id)
            finally:
                scored.unpersist()
            write_batch(dead_letter_rows(validated), os.path.join(root, "errors"), batch_id, "json")
            log = batch.sparkSession.createDataFrame(
                [(counts["records"], counts["scored_records"], counts["rejected_records"],
                  (time.time() - started) * 1000.0)],
                "records bigint, scored_records bigint, rejected_records bigint, processing_time_ms double")
            write_batch(log, os.path.join(root, "batch_log"), batch_id, "json")
        finally:
            validated.unpersist()

    return write


def start_scoring(stream: DataFrame, model: PipelineModel | FlatForest, root: str, available_now: bool = True,
                  payload: bool = False, redelivered_within: str | None = None) -> StreamingQuery:
    """ST2; ``redelivered_within`` scores a record that arrives again within that time once."""
    raw = decode_payload(stream) if payload else stream
    if redelivered_within:
        raw = drop_redelivered(raw, redelivered_within)
    writer = (validate_records(raw).writeStream.foreachBatch(make_score_writer(root, model))
              .option("checkpointLocation", os.path.join(root, "checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    with session_conf(stream.sparkSession, STATE_STORE if redelivered_within else {}):
        return writer.start()
