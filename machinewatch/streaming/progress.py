"""Per-trigger progress (ST7's lag and duration, S23): observed metrics of each micro-batch as a table.

The stream observes its own records (``DataFrame.observe``), so the counts
come out of the job that reads them; a ``StreamingQueryListener`` receives them
with the trigger's durations and appends one row per trigger. The table joins
the rollup by batch id.
"""

from __future__ import annotations

import os
import queue
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

SCHEMA = ("query_id string, run_id string, batch_id bigint, triggered_at timestamp, input_rows bigint, duration_ms bigint, "
          "add_batch_ms bigint, records bigint, errors bigint, bytes bigint, newest timestamp, lag_ms bigint")
#: Seconds that ``close`` waits for the last events of a run.
PATIENCE = 60.0


def observed(records: DataFrame, name: str, ts: str = "event_time", raw_col: str = "raw",
             valid_col: str = "is_valid") -> DataFrame:
    """``records`` with the counts of each trigger observed under ``name``; no row or column changes."""
    return records.observe(
        name, F.count(F.lit(1)).alias("records"), F.count_if(~F.col(valid_col)).alias("errors"),
        F.sum(F.length(raw_col).cast("bigint")).alias("bytes"), F.max(F.col(ts).cast("timestamp")).alias("newest"))


class ProgressTable(StreamingQueryListener):
    """Writes one row per trigger of the streams that observe under ``name`` to ``path``.

    Rows are partitioned by run and batch, so a run that is reported twice
    replaces its own rows. A thread of its own writes them: the listener bus
    never waits for a job.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.name = spark, path, f"arrivals-{uuid.uuid4().hex[:8]}"
        self._rows: queue.Queue = queue.Queue()
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()
        self._failure: Exception | None = None
        self._writer = threading.Thread(target=self._write_all, daemon=True)
        self._writer.start()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802 (names of the interface)
        self._end_of(str(event.runId))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        seen = dict(p.observedMetrics or {}).get(self.name)
        if seen is not None:
            self._rows.put((str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.durationMs.get("triggerExecution"),
                            p.durationMs.get("addBatch"), seen["records"], seen["errors"], seen["bytes"], seen["newest"]))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end_of(str(event.runId)).set()

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def _write_all(self) -> None:
        while (row := self._rows.get()) is not None:
            try:
                self._write(row)
            except Exception as error:  # kept for close(): a progress table with holes is no progress table
                self._failure = error
            finally:
                self._rows.task_done()
        self._rows.task_done()

    def _write(self, row: tuple) -> None:
        columns = ("query_id string, run_id string, batch_id bigint, triggered_at string, input_rows bigint, duration_ms bigint, "
                   "add_batch_ms bigint, records bigint, errors bigint, bytes bigint, newest timestamp")
        frame = self.spark.createDataFrame([row], columns).withColumn("triggered_at", F.to_timestamp("triggered_at"))
        lag = F.unix_millis("triggered_at") - F.unix_millis("newest")
        (frame.withColumn("lag_ms", lag).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id", "batch_id").parquet(self.path))

    def close(self, *runs: StreamingQuery) -> None:
        """Wait for all triggers of ended ``runs`` to be written, and stop listening."""
        for run in runs:
            if not self._end_of(str(run.runId)).wait(PATIENCE):
                raise TimeoutError(f"no end of run {run.runId} was reported")
        self.spark.streams.removeListener(self)
        self._rows.put(None)
        self._rows.join()
        if self._failure:
            raise self._failure


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch: its last run counts, as a replayed batch is reported again."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    values = [c for c in rows.columns if c not in ("query_id", "batch_id")]
    latest = rows.groupBy("query_id", "batch_id").agg(F.max_by(F.struct(*values), "triggered_at").alias("_v"))
    return latest.select("query_id", "batch_id", "_v.*")


def dashboard(spark: SparkSession, root: str, progress_path: str | None = None) -> DataFrame:
    """ST7 whole: each window as last written, with duration and lag of the trigger that wrote it.

    ``window_start, window_end, records, bytes, errors, batch_id,
    batch_records, duration_ms, lag_ms, newest``.
    """
    rows = spark.read.parquet(os.path.join(root, "rollup"))
    values = [c for c in rows.columns if c not in ("window_start", "window_end")]
    latest = rows.groupBy("window_start", "window_end").agg(F.max_by(F.struct(*values), "batch_id").alias("_v")).select(
        "window_start", "window_end", "_v.*")
    triggers = read_progress(spark, progress_path or os.path.join(root, "progress")).select(
        "batch_id", F.col("records").alias("batch_records"), "duration_ms", "lag_ms", "newest")
    return latest.join(triggers, "batch_id", "left")


def slow_triggers(progress: DataFrame, limit_ms: int, period: str = "300 seconds") -> DataFrame:
    """Durations and lag per period of trigger time: ``period_start, triggers, records, errors, duration_ms, lag_ms, slow``."""
    longest: Column = F.max("duration_ms")
    return progress.groupBy(F.window("triggered_at", period).alias("w")).agg(
        F.count(F.lit(1)).alias("triggers"), F.sum("records").alias("records"), F.sum("errors").alias("errors"),
        F.sum("duration_ms").alias("duration_ms"), F.max("lag_ms").alias("lag_ms"), (longest > limit_ms).alias("slow")).select(
        F.col("w.start").alias("period_start"), "triggers", "records", "errors", "duration_ms", "lag_ms", "slow")
