"""Windowed stream operators: dashboard rollups (ST7), consecutive-breach alarms
(ST5, ST6), retention / late-row split (ST8), edge-rule delivery (ST3, S13).

The window aggregates are plain ``groupBy(window(...))`` expressions, so one
function serves a batch frame and a streaming frame (with a watermark).
The alarm step runs over the closed-window table: a keyed self-join on
``window_start = previous window_start + period`` (distributed, no global
sort), and the empty-window spine is generated from the min/max window.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F

from machinewatch.operators.enrich import with_edge_rule
from machinewatch.schema import (
    ALARM_ERROR_THRESHOLD,
    ALARM_LOW_INPUT_THRESHOLD,
    ALARM_PERIOD_SECONDS,
    PLAUSIBLE_TIMES,
    RETENTION,
    READING_SCHEMA,
)
from machinewatch.sources.raw import decode_payload
from machinewatch.streaming.progress import observed
from machinewatch.streaming.transform import write_batch

PERIOD = f"{ALARM_PERIOD_SECONDS} seconds"


def _ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def window_rollup(df: DataFrame, ts: str = "event_time", period: str = PERIOD,
                  raw_col: str = "raw", valid_col: str | None = "is_valid") -> DataFrame:
    """ST7: per period: records, bytes of raw text, rejected records."""
    aggs = [F.count(F.lit(1)).alias("records"),
            F.sum(F.length(F.col(raw_col)).cast("bigint")).alias("bytes")]
    if valid_col:
        aggs.append(F.count_if(~F.col(valid_col)).alias("errors"))
    out = df.groupBy(F.window(F.col(ts), period).alias("w")).agg(*aggs)
    return out.select(_ntz(F.col("w.start")).alias("window_start"),
                      _ntz(F.col("w.end")).alias("window_end"), *[a for a in out.columns if a != "w"])


def streaming_rollup(stream: DataFrame, ts: str = "event_time", watermark: str = RETENTION,
                     period: str = PERIOD) -> DataFrame:
    """ST7/ST8 on a stream: watermark bounds the window state (24 h retention)."""
    return window_rollup(stream.withWatermark(ts, watermark), ts, period)


def window_spine(windows: DataFrame, period_seconds: int = ALARM_PERIOD_SECONDS,
                 block: int = 1024) -> DataFrame:
    """All period starts between the first and last observed window (empty ones included).

    Built block by block, so the blocks spread over tasks. Window starts
    outside ``PLAUSIBLE_TIMES`` (a time in milliseconds, say) take no part.
    """
    low, high = (F.lit(t).cast("timestamp_ntz") for t in PLAUSIBLE_TIMES)
    start = F.col("window_start")
    bounds = windows.filter((start >= low) & (start < high)).agg(
        F.min(start).alias("lo"), F.max(start).alias("hi"))
    seconds = F.unix_seconds(F.col("hi").cast("timestamp")) - F.unix_seconds(F.col("lo").cast("timestamp"))
    blocks = bounds.filter(F.col("lo").isNotNull()).withColumn("n", F.floor(seconds / period_seconds)).select(
        "lo", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("n") / block))).alias("block"))
    periods = blocks.repartition("block").select("lo", "n", F.explode(F.sequence(
        F.col("block") * block, F.col("block") * block + (block - 1))).alias("i")).filter(F.col("i") <= F.col("n"))
    return periods.select((F.col("lo") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.col("i") * period_seconds)).alias("window_start"))


def consecutive_breach(windows: DataFrame, value_col: str, breach: Column,
                       periods: int = 2, period_seconds: int = ALARM_PERIOD_SECONDS) -> DataFrame:
    """Alarm when ``breach`` holds in ``periods`` consecutive windows (ST5, ST6).

    Each earlier period is attached by an equi-join on its start time, so the
    check is distributed over windows.
    """
    flagged = windows.withColumn("breach", breach)
    out = flagged
    for k in range(1, periods):
        prev = flagged.select(
            (F.col("window_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                        F.lit(k * period_seconds))).alias("window_start"),
            F.col("breach").alias(f"_breach_{k}"))
        out = out.join(prev, "window_start", "left")
    alarm = F.col("breach")
    for k in range(1, periods):
        alarm = alarm & F.coalesce(F.col(f"_breach_{k}"), F.lit(False))
    return out.withColumn("alarm", alarm).drop(*[f"_breach_{k}" for k in range(1, periods)]).select(
        "window_start", value_col, "breach", "alarm")


def alarm_errors(rollup: DataFrame, threshold: int = ALARM_ERROR_THRESHOLD) -> DataFrame:
    """ST5: rejected records per period > threshold in two consecutive periods.

    A period without rows has no errors (treated as 0, so never a breach).
    """
    return consecutive_breach(rollup.select("window_start", "errors"), "errors",
                              F.col("errors") > F.lit(threshold))


def alarm_low_throughput(rollup: DataFrame, threshold: int = ALARM_LOW_INPUT_THRESHOLD) -> DataFrame:
    """ST6: input records per period < threshold in two consecutive periods; empty periods count 0."""
    spine = window_spine(rollup)
    filled = spine.join(rollup.select("window_start", "records"), "window_start", "left").withColumn(
        "records", F.coalesce(F.col("records"), F.lit(0)).cast("bigint"))
    return consecutive_breach(filled, "records", F.col("records") < F.lit(threshold))


def late_split(df: DataFrame, batch_col: str = "batch_id", ts: str = "event_time",
               retention: dt.timedelta = dt.timedelta(hours=24)) -> DataFrame:
    """ST8 (batch form): a row is late when older than the max event time of all
    earlier batches minus the retention; the watermark a stream would apply.

    Per-batch maxima are a small table (one row per batch); their running
    maximum is joined back by batch id.
    """
    from pyspark.sql import Window

    per_batch = df.groupBy(batch_col).agg(F.max(ts).alias("_batch_max"))
    # Running max over earlier batches: one row per batch, so this window is tiny.
    running = Window.orderBy(batch_col).rowsBetween(Window.unboundedPreceding, -1)
    earlier = per_batch.select(batch_col, F.max("_batch_max").over(running).alias("_prior_max"))
    bound = F.col("_prior_max") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                     F.lit(int(retention.total_seconds())))
    return df.join(earlier, batch_col, "left").withColumn(
        "is_late", F.coalesce(F.col(ts) < bound, F.lit(False))).drop("_prior_max")


def start_rollup(stream: DataFrame, root: str, ts: str = "event_time", available_now: bool = True,
                 observe: str | None = None) -> StreamingQuery:
    """ST7 as a stream: every micro-batch writes the windows it changed under its batch id.

    A replayed batch replaces its own rows; ``read_rollup`` takes each
    window's latest state, over which the alarms (ST5, ST6) are evaluated.
    ``observe`` names a progress table's metrics (``progress.ProgressTable``).
    """
    if observe:
        stream = observed(stream, observe, ts)
    writer = (streaming_rollup(stream, ts).writeStream.outputMode("update")
              .foreachBatch(lambda batch, batch_id: write_batch(batch, os.path.join(root, "rollup"), batch_id))
              .option("checkpointLocation", os.path.join(root, "checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="60 seconds")
    return writer.start()


def read_rollup(spark: SparkSession, root: str) -> DataFrame:
    """The windows as last written by ``start_rollup``."""
    rows = spark.read.parquet(os.path.join(root, "rollup"))
    values = [c for c in rows.columns if c not in ("window_start", "window_end", "batch_id")]
    latest = rows.groupBy("window_start", "window_end").agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
    return latest.select("window_start", "window_end", "_v.*")


def closed_windows(rollup: DataFrame, delay_seconds: int = 0) -> DataFrame:
    """The windows that can no longer change: those that end by the start of the newest one, less the allowed delay.

    The newest window has only begun; judged as it stands, it would be a low
    one. Windows outside ``PLAUSIBLE_TIMES`` close nothing.
    """
    low, high = (F.lit(t).cast("timestamp_ntz") for t in PLAUSIBLE_TIMES)
    start = F.col("window_start")
    newest = rollup.filter((start >= low) & (start < high)).agg(F.max(start)).first()[0]
    bound = None if newest is None else newest - dt.timedelta(seconds=delay_seconds)
    return rollup.filter(F.col("window_end") <= F.lit(bound).cast("timestamp_ntz"))


def _state_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The last batch before ``batch_id`` with a state: its predecessor, else found by the folders' names."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={batch_id - 1}")):
        return batch_id - 1
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    earlier = [int(n.split("=", 1)[1]) for n in names if n.startswith("batch_id=")]
    return max((i for i in earlier if i < batch_id), default=None)


def late_router(paths_root: str, ts: str = "event_time", retention: dt.timedelta = dt.timedelta(hours=24)):
    """ST8 (stream form): ``foreachBatch`` body routing rows older than the running
    watermark to ``late/`` and the rest to ``on_time/``.

    ``state/`` holds the latest event time up to each batch. A batch reads its
    predecessor's row only, whatever came before; a replayed batch sees the same
    one. Without any state nothing is late; a state that cannot be read fails
    the batch.
    """
    state_path = os.path.join(paths_root, "state")

    def route(batch: DataFrame, batch_id: int) -> None:
        spark, prior = batch.sparkSession, None
        before = _state_before(spark, state_path, batch_id)
        if before is not None:
            state = spark.read.schema("latest timestamp_ntz").parquet(f"{state_path}/batch_id={before}")
            prior = state.agg(F.max("latest").alias("m")).first()["m"]
        marked = batch.withColumn(
            "is_late",
            F.lit(False) if prior is None else
            F.coalesce(F.col(ts).cast("timestamp_ntz") < F.lit(prior - retention).cast("timestamp_ntz"), F.lit(False)))
        marked = marked.persist()
        try:
            for flag, sub in ((True, "late"), (False, "on_time")):
                write_batch(marked.filter(F.col("is_late") == flag), os.path.join(paths_root, sub), batch_id)
            newest = F.max(F.col(ts).cast("timestamp_ntz"))
            if prior is not None:
                newest = F.greatest(newest, F.lit(prior).cast("timestamp_ntz"))
            write_batch(marked.agg(newest.alias("latest")).coalesce(1), state_path, batch_id)
        finally:
            marked.unpersist()

    return route


def start_edge_rule(stream: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                    payload: bool = True) -> StreamingQuery:
    """ST3 + S13: decode, edge rule, gzip JSON lines partitioned by arrival hour.

    With ``payload`` each line is a transport record ``{event_id, data, body}``.
    """
    if payload:
        rec = F.from_json("raw", "event_id bigint, data string, body string")
        stream = stream.select(rec.alias("rec")).select("rec.*")
    raw = decode_payload(stream) if payload else stream
    parsed = raw.select("*", F.from_json("raw", READING_SCHEMA).alias("r")).select("*", "r.*").drop("r")
    scored = with_edge_rule(parsed).drop("raw", "data", "body")
    arrival = F.current_timestamp()
    out = scored.withColumns({"year": F.year(arrival), "month": F.month(arrival),
                              "day": F.dayofmonth(arrival), "hour": F.hour(arrival)})
    writer = (out.writeStream.format("json").option("compression", "gzip")
              .option("checkpointLocation", checkpoint).partitionBy("year", "month", "day", "hour"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="60 seconds")
    return writer.start(out_path)
