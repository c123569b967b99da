"""Aggregations: hourly/daily/monthly machine statistics, micro-batch statistics,
trends, latest reading, run statistics.

Every operator is a partial + final hash aggregate (map-side combine), so a
machine that holds a third of all rows still sends one partial row per map
task, never all of its readings to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from machinewatch.functions.features import count_when
from machinewatch.operators.enrich import LAG_NAMES
from machinewatch.schema import SENSORS, TREND_DELTAS, TREND_MIN_READINGS, TREND_NAMES

HOUR_KEYS = ("machine_id", "year", "month", "day", "hour")
DAY_KEYS = ("machine_id", "year", "month", "day")
MONTH_KEYS = ("machine_id", "year", "month")


def machine_stats(processed: DataFrame, keys: Sequence[str] = HOUR_KEYS) -> DataFrame:
    """A1: hourly statistics per machine; ``anomaly_count`` is the sum of scores."""
    aggs: list[Column] = []
    for s in SENSORS:
        aggs.append(F.avg(s).alias(f"avg_{s}"))
    for s in SENSORS:
        aggs.append(F.stddev_samp(s).alias(f"std_{s}"))
    for s in SENSORS:
        aggs += [F.max(s).alias(f"max_{s}"), F.min(s).alias(f"min_{s}")]
    aggs += [
        F.count(F.lit(1)).alias("record_count"),
        F.sum("total_anomaly_score").cast("bigint").alias("anomaly_count"),
    ]
    return processed.groupBy(*keys).agg(*aggs)


def anomaly_summary(processed: DataFrame) -> DataFrame:
    """A2: daily summary per machine."""
    return processed.groupBy(*DAY_KEYS).agg(
        F.count(F.lit(1)).alias("total_records"),
        count_when(F.col("total_anomaly_score") > 0).alias("anomaly_records"),
        F.avg("temperature").alias("avg_temperature"),
        F.avg("vibration").alias("avg_vibration"),
        F.avg("pressure").alias("avg_pressure"),
        F.max("temperature").alias("max_temperature"),
        F.min("temperature").alias("min_temperature"),
    )


def machine_performance(daily: DataFrame) -> DataFrame:
    """A3: monthly performance from the daily summary (mean of daily means)."""
    return daily.groupBy(*MONTH_KEYS).agg(
        F.avg("avg_temperature").alias("monthly_avg_temp"),
        F.avg("avg_vibration").alias("monthly_avg_vib"),
        F.avg("avg_pressure").alias("monthly_avg_pressure"),
        F.sum("anomaly_records").cast("bigint").alias("monthly_anomalies"),
        F.sum("total_records").cast("bigint").alias("monthly_total_records"),
        (F.sum("anomaly_records").cast("double") / F.sum("total_records").cast("double")
         * F.lit(100.0)).alias("anomaly_percentage"),
    )


def run_stats(processed: DataFrame) -> DataFrame:
    """Total rows, distinct machines, anomalous rows in one aggregate."""
    return processed.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("machine_id").alias("unique_machines"),
        count_when(F.col("total_anomaly_score") > 0).alias("anomaly_records"),
    )


def run_stats_metrics() -> list[Column]:
    """S20 as ``DataFrame.observe`` metrics (collected during a write, no extra scan)."""
    return [
        F.count(F.lit(1)).alias("total_records"),
        count_when(F.col("total_anomaly_score") > 0).alias("anomaly_records"),
    ]


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def _order_key(df: DataFrame, ts: str) -> Column:
    """Time, then the id if the rows have one, then the sensor values."""
    tie = ["event_id"] if "event_id" in df.columns else []
    return F.struct(F.col(ts), *[F.col(c) for c in (*tie, *SENSORS)])


def _stats_aggs() -> list[Column]:
    aggs: list[Column] = []
    for s in SENSORS:
        p = LAG_NAMES[s]
        x = F.col(s).cast("double")
        aggs += [
            F.avg(x).alias(f"{p}_mean"),
            F.when(F.count(x) > 1, F.stddev_samp(x)).otherwise(F.lit(0.0)).alias(f"{p}_std"),
            F.min(x).alias(f"{p}_min"),
            F.max(x).alias(f"{p}_max"),
        ]
    return aggs


def _grouped(df: DataFrame, group_cols: Sequence[str]):
    return df.groupBy(*group_cols) if group_cols else df.groupBy()


def batch_stats(df: DataFrame, group_cols: Sequence[str] = ("machine_id",)) -> DataFrame:
    """A4: mean, sample std (0 when one reading), min, max per sensor and group.

    ``group_cols=[]`` gives one row over the whole batch (the reference's
    batch-wide behaviour); an empty input gives no row per group.
    """
    return _grouped(df, group_cols).agg(F.count(F.lit(1)).alias("batch_records"), *_stats_aggs())


def _trend(first: Column, last: Column, delta: float) -> Column:
    return (
        F.when(last > first + F.lit(delta), F.lit("increasing"))
        .when(last < first - F.lit(delta), F.lit("decreasing"))
        .otherwise(F.lit("stable"))
    )


def _trend_aggs(df: DataFrame, ts: str) -> list[Column]:
    order = _order_key(df, ts)
    reading = F.struct(*[F.col(s).cast("double").alias(s) for s in SENSORS])
    return [
        F.count(F.lit(1)).alias("_n"),
        F.min_by(reading, order).alias("_first"),
        F.max_by(reading, order).alias("_last"),
    ]


def _trend_columns() -> dict[str, Column]:
    enough = F.col("_n") >= TREND_MIN_READINGS
    return {
        "trend": F.when(~enough, F.lit("insufficient_data")),
        **{
            TREND_NAMES[s]: F.when(
                enough, _trend(F.col(f"_first.{s}"), F.col(f"_last.{s}"), TREND_DELTAS[s])
            )
            for s in SENSORS
        },
    }


def detect_trends(
    df: DataFrame, group_cols: Sequence[str] = ("machine_id",), ts: str = "event_timestamp"
) -> DataFrame:
    """Last versus first reading per group; fewer than 3 readings -> insufficient_data."""
    agg = _grouped(df, group_cols).agg(*_trend_aggs(df, ts))
    return agg.withColumns(_trend_columns()).drop("_n", "_first", "_last")


def latest_reading(
    df: DataFrame, group_cols: Sequence[str] = ("machine_id",), ts: str = "event_timestamp"
) -> DataFrame:
    """The newest row per group, as a ``max_by`` aggregate (no sort of the group)."""
    others = [c for c in df.columns if c not in group_cols]
    latest = F.max_by(F.struct(*[F.col(c) for c in others]), _order_key(df, ts))
    return _grouped(df, group_cols).agg(latest.alias("_latest")).select(*group_cols, "_latest.*")


STAT_COLUMNS = [f"{LAG_NAMES[s]}_{m}" for s in SENSORS for m in ("mean", "std", "min", "max")]
TREND_COLUMNS = ["trend", *[TREND_NAMES[s] for s in SENSORS]]


def latest_with_stats(
    df: DataFrame, group_cols: Sequence[str] = ("machine_id",), ts: str = "event_timestamp"
) -> DataFrame:
    """J1's side of groups: one row per group of > 1 row, with its statistics, trends and the key of its latest row.

    Records need no id: the latest row goes by time, then by the id if there
    is one, else by the sensor values, then by a hash of its whole content.
    """
    latest = F.max(F.struct(_order_key(df, ts).alias("o"), _content(df).alias("c")))
    agg = _grouped(df, group_cols).agg(*_stats_aggs(), *_trend_aggs(df, ts), latest.alias("_latest"))
    return agg.filter(F.col("_n") > 1).withColumns(_trend_columns()).select(
        *[F.col(c).alias(f"_g_{c}") for c in group_cols], F.col("_latest.o").alias("_g_order"),
        F.col("_latest.c").alias("_g_content"), *STAT_COLUMNS, *TREND_COLUMNS)


def _content(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in df.columns])


def attach_batch_stats(
    df: DataFrame, group_cols: Sequence[str] = ("machine_id",), ts: str = "event_timestamp",
    groups: DataFrame | None = None
) -> DataFrame:
    """Statistics and trends of the group on its latest row only (groups of > 1 row).

    ``groups`` is ``latest_with_stats`` of the same rows, if the caller holds
    it. Rows meet it by group and content hash, so a hot group is no hot key;
    held and small, it is sent to the rows and these are not shuffled at all.
    Only copies of a latest row (redelivered records) are numbered, and the
    first of them gets the statistics; all others keep their place.
    """
    if not group_cols:
        # Batch-wide: one constant group key.
        return attach_batch_stats(df.withColumn("_batch", F.lit(0)), ["_batch"], ts, groups).drop("_batch")
    if groups is None:
        groups = latest_with_stats(df, group_cols, ts)
    same = (F.col("_content") == F.col("_g_content")) & (F.col("_order") == F.col("_g_order"))
    for c in group_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    joined = df.withColumns({"_content": _content(df), "_order": _order_key(df, ts)}).join(groups, same, "left")
    attached = [*STAT_COLUMNS, *TREND_COLUMNS]
    copies = Window.partitionBy(*group_cols).orderBy("_content")
    numbered = joined.filter(F.col("_g_content").isNotNull()).withColumn("_copy", F.row_number().over(copies))
    latest = numbered.select(*df.columns, *[F.when(F.col("_copy") == 1, F.col(c)).alias(c) for c in attached])
    return joined.filter(F.col("_g_content").isNull()).select(*df.columns, *attached).unionByName(latest)
