"""Row-level enrichment (P1-P7, P21, P22) and the per-machine lag window."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from machinewatch.functions.features import (
    date_part_columns,
    edge_rule,
    flag_columns,
    ratio_columns,
    score_column,
)
from machinewatch.schema import DATA_VERSION, ETL_RULES, MODEL_FEATURES, SENSORS, Thresholds
from machinewatch.session import scratch_path

LAG_NAMES = {"temperature": "temp", "vibration": "vib", "pressure": "pressure"}


def event_time(df: DataFrame, source: str = "timestamp") -> DataFrame:
    """``event_timestamp`` from epoch seconds, or the current time if the column is absent."""
    if "event_timestamp" in df.columns:
        return df
    if source in df.columns:
        value = F.timestamp_seconds(F.col(source)).cast("timestamp_ntz")
    else:
        value = F.current_timestamp().cast("timestamp_ntz")
    return df.withColumn("event_timestamp", value)


def derive_features(
    df: DataFrame,
    rules: Thresholds = ETL_RULES,
    processing_time: bool = True,
) -> DataFrame:
    """P1-P6 in one projection: processing time, ratios, flags, score, date parts."""
    df = event_time(df)
    cols: dict[str, Column] = {}
    if processing_time:
        cols["processing_timestamp"] = F.current_timestamp()
    cols.update(ratio_columns())
    cols.update(flag_columns(rules))
    df = df.withColumns(cols)
    return df.withColumns({"total_anomaly_score": score_column(), **date_part_columns()})


def with_edge_rule(df: DataFrame) -> DataFrame:
    """The any-of edge rule as ``anomaly_score``."""
    return df.withColumn("anomaly_score", edge_rule())


def enrich_stream(df: DataFrame, raw_col: str | None = "raw", now_ts: Column | None = None,
                  whole_col: str | None = None) -> DataFrame:
    """Fill an absent ``timestamp`` with now, add ratios, ``processed_at``, ``data_version``.

    "Absent" means the key is missing from the JSON text (``json_object_keys``);
    a present-but-null timestamp stays NULL so the validator rejects it. Where
    ``whole_col`` is true (``parse_raw``), a timestamp that is not null is present.
    """
    now = now_ts if now_ts is not None else F.current_timestamp()
    if raw_col and raw_col in df.columns:
        present = F.coalesce(
            F.array_contains(F.json_object_keys(F.col(raw_col)), F.lit("timestamp")), F.lit(False)
        )
        if whole_col:
            present = F.when(F.col(whole_col) & F.col("timestamp").isNotNull(), F.lit(True)).otherwise(present)
        filled = F.when(present, F.col("timestamp")).otherwise(
            F.unix_seconds(now).cast("string" if _is_string(df, "timestamp") else "bigint")
        )
        df = df.withColumn("timestamp", filled)
    t = F.col("temperature").try_cast("double")
    v = F.col("vibration").try_cast("double")
    p = F.col("pressure").try_cast("double")
    return df.withColumns(
        {
            **ratio_columns(t, v, p),
            "processed_at": now,
            "data_version": F.lit(DATA_VERSION),
        }
    )


def _is_string(df: DataFrame, name: str) -> bool:
    return name in df.columns and df.schema[name].dataType.typeName() == "string"


def _order_columns(df: DataFrame, ts: str, tie_break: Sequence[str] | None) -> list[str]:
    if tie_break is None:
        tie_break = ["event_id"] if "event_id" in df.columns else list(SENSORS)
    return [ts, *tie_break]


#: Readings that one lag group may hold, and the buckets to choose from, largest first.
LAG_GROUP_ROWS = 1_000_000
LAG_BUCKETS = ("day", "hour", "minute", "second")


def choose_bucket(df: DataFrame, partition_col: str = "machine_id", ts: str = "event_timestamp",
                  limit: int = LAG_GROUP_ROWS) -> str:
    """The largest time bucket whose fullest (machine, bucket) group holds at most ``limit`` rows.

    Measured, not assumed: rows are counted per machine and second (map-side
    sums over two columns), and those counts are summed up to the larger buckets.
    """
    counts = df.groupBy(partition_col, F.date_trunc(LAG_BUCKETS[-1], F.col(ts)).alias("b")).agg(
        F.count(F.lit(1)).alias("n"))
    for bucket in LAG_BUCKETS:
        fullest = counts.groupBy(partition_col, F.date_trunc(bucket, F.col("b"))).agg(
            F.sum("n").alias("n")).agg(F.max("n").alias("n")).first()["n"]
        if fullest is None or fullest <= limit:
            return bucket
    return LAG_BUCKETS[-1]


def _shifted(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one range with the row before: ``_lag_*``, and marks on the range's first and last row."""
    def marked(batch: pa.RecordBatch, mark: pa.BooleanArray) -> pa.RecordBatch:
        return batch.append_column("_last", mark)

    before = held = None
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        rows = pa.Table.from_batches([batch.select([key, *SENSORS])])
        opening = before is None
        # The first row of a range has no row before it here; it stands in for one, and is marked.
        shifted = pa.concat_tables([rows.slice(0, 1) if opening else before, rows.slice(0, n - 1)]).combine_chunks()
        same = pc.or_(pc.fill_null(pc.equal(shifted[key], rows[key]), False),
                      pc.and_(pc.is_null(shifted[key]), pc.is_null(rows[key]))).combine_chunks()
        first = pa.array([opening] + [False] * (n - 1))
        same = pc.and_(same, pc.invert(first))
        before = rows.slice(n - 1)
        for s in SENSORS:
            lagged = pc.if_else(same, shifted[s].combine_chunks(), pa.scalar(None, batch.schema.field(s).type))
            batch = batch.append_column(f"_lag_{s}", lagged)
        batch = batch.append_column("_first", first)
        if held is not None:
            yield marked(held, pa.array([False] * len(held)))
        held = batch
    if held is not None:
        yield marked(held, pa.array([False] * (len(held) - 1) + [True]))


def lag_pass(df: DataFrame, order: Sequence[str], partition_col: str = "machine_id") -> DataFrame:
    """Rows in ranges of (machine, order), each with the row before it in its range: one scan, one shuffle."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = [F.col(partition_col), *[F.col(c) for c in order]]
    ranged = df.repartitionByRange(parts, *line).sortWithinPartitions(*line).withColumn("_part", F.spark_partition_id())
    fields = [T.StructField(f"_lag_{s}", df.schema[s].dataType) for s in SENSORS]
    marks = [T.StructField(m, T.BooleanType()) for m in ("_first", "_last")]
    schema = T.StructType([*ranged.schema.fields, *fields, *marks])
    return ranged.mapInArrow(lambda batches: _shifted(batches, partition_col), schema)


def lag_over_ranges(df: DataFrame, order: Sequence[str], partition_col: str = "machine_id") -> DataFrame:
    """``df`` with ``_prev``, the machine's reading before each row.

    Ranges are of about equal size whatever the machines are, so one that
    holds most rows is spread over most ranges. A machine that goes on over a
    border gets the last row of the range before: one row per range.
    """
    path = scratch_path(df.sparkSession, f"lag-{uuid.uuid4().hex}")
    lag_pass(df, order, partition_col).write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    lasts = stored.filter("_last").select("_part", F.struct(F.col(partition_col).alias("key"), *SENSORS).alias("_end"))
    carried = lasts.select("_part", F.lag("_end").over(Window.partitionBy(F.lit(0)).orderBy("_part")).alias("_end"))
    # A row per range: as many as the session has shuffle partitions.
    joined = stored.join(F.broadcast(carried), "_part", "left")
    over = F.col("_first") & F.col("_end").isNotNull() & F.col("_end.key").eqNullSafe(F.col(partition_col))
    prev = F.struct(*[F.when(over, F.col(f"_end.{s}")).otherwise(F.col(f"_lag_{s}")).alias(s) for s in SENSORS])
    return joined.select(*df.columns, prev.alias("_prev"))


def lag_features(
    df: DataFrame,
    partition_col: str = "machine_id",
    ts: str = "event_timestamp",
    tie_break: Sequence[str] | None = None,
    bucket: str | None = "ranges",
) -> DataFrame:
    """W1 + P21: previous reading per machine (``*_lag_1``) and the differences.

    ``bucket="ranges"`` deals the rows by sampled ranges of (machine, time):
    one scan, one shuffle, and a hot machine over many tasks. ``None`` is the
    plain ``Window.partitionBy(machine)`` plan: one task per machine, fine for
    many small machines. A time bucket splits each machine's series by
    ``date_trunc(bucket, ts)`` and carries the last reading of the previous
    non-empty bucket through a small join; ``"auto"`` takes the largest bucket
    whose measured groups are small enough.
    """
    if bucket == "auto":
        bucket = choose_bucket(df, partition_col, ts)
    order = _order_columns(df, ts, tie_break)
    reading = F.struct(*[F.col(s).alias(s) for s in SENSORS])
    if bucket == "ranges":
        out = lag_over_ranges(df, order, partition_col)
    elif bucket is None:
        w = Window.partitionBy(partition_col).orderBy(*order)
        prev = F.lag(reading, 1).over(w)
        out = df.withColumn("_prev", prev)
    else:
        bcol = "_lag_bucket"
        staged = df.withColumn(bcol, F.date_trunc(bucket, F.col(ts)))
        w_in = Window.partitionBy(partition_col, bcol).orderBy(*order)
        inner = staged.withColumn("_prev_in", F.lag(reading, 1).over(w_in))
        # Last reading of each (machine, bucket): a partial+final aggregate (skew-safe).
        last = staged.groupBy(partition_col, bcol).agg(
            F.max_by(reading, F.struct(*[F.col(c) for c in order])).alias("_last")
        )
        # Carry = last reading of the previous non-empty bucket; one row per bucket.
        w_b = Window.partitionBy(partition_col).orderBy(bcol)
        carry = last.select(partition_col, bcol, F.lag("_last", 1).over(w_b).alias("_carry"))
        out = (
            inner.join(carry, [partition_col, bcol], "left")
            .withColumn("_prev", F.coalesce(F.col("_prev_in"), F.col("_carry")))
            .drop("_prev_in", "_carry", bcol)
        )
    lags = {f"{LAG_NAMES[s]}_lag_1": F.col(f"_prev.{s}") for s in SENSORS}
    out = out.withColumns(lags)
    diffs = {f"{LAG_NAMES[s]}_diff": F.col(s) - F.col(f"{LAG_NAMES[s]}_lag_1") for s in SENSORS}
    return out.withColumns(diffs).drop("_prev")


def feature_matrix(df: DataFrame, label: str | None = "label") -> DataFrame:
    """The five model features in fixed order (+ label)."""
    if "temp_vib_ratio" not in df.columns:
        df = df.withColumns(ratio_columns())
    cols = [F.col(c) for c in MODEL_FEATURES]
    if label:
        cols.append(F.col(label).cast("double").alias("label"))
    keep = [c for c in ("event_id", "machine_id") if c in df.columns]
    return df.select(*keep, *cols)


def lenient_features(df: DataFrame) -> DataFrame:
    """P11 lenient: a missing or non-numeric sensor becomes 0.0, then the ratios."""
    base = {s: F.coalesce(F.col(s).try_cast("double"), F.lit(0.0)) for s in SENSORS}
    df = df.withColumns(base)
    return df.withColumns(ratio_columns())
