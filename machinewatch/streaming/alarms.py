"""Live alarms on closed periods (ST5, ST6), as one streaming query.

Each task first sums its own records per key and period, so a key's state
machine gets a few rows per task however many records there are. The state
holds the counts of the periods that are still open, the next period due and
how many breaches ran up to it. A period is judged when the watermark has
passed its end: what is still open never is. Periods without any record are
filled in between two closed ones and, by an event-time timer, after the last
one, so silence is judged as well as noise.

Times are those of periods: with a newest record in the period that starts at
s, all periods are closed that end at or before s less the allowed delay. A
record of a closed period comes too late and changes nothing. Event times outside ``PLAUSIBLE_TIMES`` and null ones belong to no
period: one reading in the year 9999 would otherwise close all periods for good.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from machinewatch.schema import (
    ALARM_ERROR_THRESHOLD,
    ALARM_EVALUATION_PERIODS,
    ALARM_LOW_INPUT_THRESHOLD,
    ALARM_PERIOD_SECONDS,
    PLAUSIBLE_TIMES,
)
from machinewatch.streaming.transform import write_batch
from machinewatch.streaming.windows import window_rollup, window_spine

#: Seconds between the newest period's start and the end of the last closed one.
DELAY = 600
#: Empty periods that are handed over at once.
BLOCK = 4096

COUNTS = "alarm_key string, start bigint, records bigint, errors bigint"
OUTPUT = ("alarm_key string, window_start timestamp, window_end timestamp, records bigint, errors bigint, "
          "errors_alarm boolean, low_input_alarm boolean")
STATE = "due bigint, judged boolean, errors_run bigint, low_run bigint, open string"


def plausible(ts: str) -> Column:
    low, high = (F.lit(t).cast("timestamp") for t in PLAUSIBLE_TIMES)
    return F.col(ts).cast("timestamp").between(low, high)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's records per key and period."""
    parts = [pa.Table.from_batches([b]).group_by(["alarm_key", "start"]).aggregate([("one", "sum"), ("bad", "sum")])
             for b in batches if len(b)]
    if parts:
        sums = pa.concat_tables(parts).group_by(["alarm_key", "start"]).aggregate([("one_sum", "sum"), ("bad_sum", "sum")])
        sums = sums.select(["alarm_key", "start", "one_sum_sum", "bad_sum_sum"]).rename_columns(
            ["alarm_key", "start", "records", "errors"])
        yield from sums.combine_chunks().to_batches()


def period_counts(stream: DataFrame, key: Column, ts: str = "event_time", delay: int = DELAY,
                  valid_col: str = "is_valid") -> DataFrame:
    """``alarm_key, start, records, errors, ends`` per task, key and period, with the watermark on the periods' ends."""
    start = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / ALARM_PERIOD_SECONDS) * ALARM_PERIOD_SECONDS
    one = F.lit(1).cast("bigint")
    rows = stream.filter(plausible(ts)).select(
        key.alias("alarm_key"), start.alias("start"), one.alias("one"), F.when(F.col(valid_col), one * 0).otherwise(one).alias("bad"))
    counts = rows.mapInArrow(_summed, COUNTS).withColumn("ends", F.timestamp_seconds(F.col("start") + ALARM_PERIOD_SECONDS))
    # The newest period's end, less its length and the delay, has passed the end of what is closed.
    return counts.withWatermark("ends", f"{delay + ALARM_PERIOD_SECONDS} seconds")


def _judge(periods: int, error_threshold: int, low_threshold: int):
    """The state function of one key: counts in, judged periods out."""
    step = ALARM_PERIOD_SECONDS

    def run(key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        due, judged, errors_run, low_run, text = state.get if state.exists else (None, False, 0, 0, "{}")
        held = {int(start): counts for start, counts in json.loads(text).items()}
        if not state.hasTimedOut:
            for frame in frames:
                for start, records, errors in zip(*(frame[c].tolist() for c in ("start", "records", "errors")), strict=True):
                    if not judged or start >= due:
                        own = held.setdefault(start, [0, 0])
                        own[0], own[1] = own[0] + records, own[1] + errors
        if not judged:
            due = min(held)
        # The watermark has closed every period up to it, with or without records.
        closed = state.getCurrentWatermarkMs() // 1000
        rows = []
        while due + step <= closed:
            records, errors = held.pop(due, (0, 0))
            errors_run = errors_run + 1 if errors > error_threshold else 0
            low_run = low_run + 1 if records < low_threshold else 0
            rows.append((key[0], due, records, errors, errors_run >= periods, low_run >= periods))
            due, judged = due + step, True
            if len(rows) == BLOCK:
                yield _frame(rows)
                rows = []
        state.update((due, judged, errors_run, low_run, json.dumps(held)))
        # Due as soon as the watermark reaches the end of the next period.
        state.setTimeoutTimestamp(max((due + step) * 1000 - 1, state.getCurrentWatermarkMs()))
        if rows:
            yield _frame(rows)

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["alarm_key", "start", "records", "errors", "errors_alarm", "low_input_alarm"])
    start = pd.to_datetime(frame.pop("start"), unit="s")
    frame.insert(1, "window_start", start)
    frame.insert(2, "window_end", start + pd.Timedelta(seconds=ALARM_PERIOD_SECONDS))
    return frame


def live_alarms(stream: DataFrame, key: Column | None = None, ts: str = "event_time", delay: int = DELAY,
                periods: int = ALARM_EVALUATION_PERIODS, error_threshold: int = ALARM_ERROR_THRESHOLD,
                low_threshold: int = ALARM_LOW_INPUT_THRESHOLD, valid_col: str = "is_valid") -> DataFrame:
    """One row per key and closed period, empty ones included, with both alarms (append mode).

    ``key`` is one key for the whole stream by default; a column, the machine
    say, gives alarms for each of its values.
    """
    counts = period_counts(stream, F.lit("all") if key is None else key, ts, delay, valid_col)
    return counts.groupBy("alarm_key").applyInPandasWithState(
        _judge(periods, error_threshold, low_threshold), OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def start_alarms(stream: DataFrame, root: str, available_now: bool = True, **options) -> StreamingQuery:
    """ST5 and ST6 live: judged periods to ``periods/``, and those in alarm to ``alarms/`` as they close."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_batch(batch, os.path.join(root, "periods"), batch_id)
            write_batch(batch.filter("errors_alarm OR low_input_alarm"), os.path.join(root, "alarms"), batch_id)
        finally:
            batch.unpersist()

    writer = (live_alarms(stream, **options).writeStream.outputMode("append").foreachBatch(write)
              .option("checkpointLocation", os.path.join(root, "checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="60 seconds")
    return writer.start()


def closed_alarms(records: DataFrame, ts: str = "event_time", delay: int = DELAY,
                  periods: int = ALARM_EVALUATION_PERIODS, error_threshold: int = ALARM_ERROR_THRESHOLD,
                  low_threshold: int = ALARM_LOW_INPUT_THRESHOLD, raw_col: str = "raw") -> DataFrame:
    """The batch twin over a whole table: the periods that its newest record has closed.

    ``window_start, window_end, records, errors, errors_alarm, low_input_alarm``.
    """
    sound = records.filter(plausible(ts))
    newest = sound.agg(F.max(F.col(ts).cast("timestamp_ntz")).alias("newest")).first()["newest"]
    rollup = window_rollup(sound, ts, raw_col=raw_col)
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ALARM_PERIOD_SECONDS))
    spine = window_spine(rollup).withColumn("window_end", F.col("window_start") + step)
    if newest is not None:
        reached = int(newest.replace(tzinfo=dt.timezone.utc).timestamp()) // ALARM_PERIOD_SECONDS * ALARM_PERIOD_SECONDS - delay
        newest = dt.datetime.fromtimestamp(reached, dt.timezone.utc).replace(tzinfo=None)
    closed = spine.filter(F.col("window_end") <= F.lit(newest).cast("timestamp_ntz"))
    filled = closed.join(rollup.select("window_start", "records", "errors"), "window_start", "left").fillna(0, ["records", "errors"])
    number = F.floor(F.unix_seconds(F.col("window_start").cast("timestamp")) / ALARM_PERIOD_SECONDS)
    judged = filled.select("*", number.alias("_i"), (F.col("errors") > error_threshold).alias("_e"),
                           (F.col("records") < low_threshold).alias("_l"))
    spread = judged.select("*", F.explode(F.sequence(F.lit(0), F.lit(periods - 1))).alias("_back"))
    # Each period's breach counts for itself and for the next ones; a run is complete when all its members are.
    votes = spread.select((F.col("_i") + F.col("_back")).alias("_i"), "_e", "_l").groupBy("_i").agg(
        F.count_if("_e").alias("_es"), F.count_if("_l").alias("_ls"))
    return judged.join(votes, "_i").select(
        "window_start", "window_end", "records", "errors", (F.col("_es") >= periods).alias("errors_alarm"),
        (F.col("_ls") >= periods).alias("low_input_alarm"))
