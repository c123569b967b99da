"""The monitoring query catalogue over the processed ``sensor_data`` table.

Each query takes the processed DataFrame and a bound ``as_of`` time (the
catalogue's ``NOW()``) and returns a lazy DataFrame. Time filters are
literal bounds, so they reach the Parquet scan; every aggregate is a
partial + final hash aggregate (map-side combine, skew-safe per machine).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from machinewatch.functions.features import (
    count_when,
    outlier_predicate,
    outlier_type,
    percent,
    score_level,
)
from machinewatch.functions.time import prune_recent
from machinewatch.schema import EFFICIENCY_LIMITS, ENERGY_LIMITS



def _score() -> F.Column:
    return F.col("total_anomaly_score")


def _ts() -> F.Column:
    return F.col("event_timestamp")


def _date() -> F.Column:
    return F.to_date(_ts())


def _hour() -> F.Column:
    return F.hour(_ts()).cast("int")


def _anomalies() -> F.Column:
    return count_when(_score() > 0)


def recent_readings(sd: DataFrame, as_of: dt.datetime, limit: int = 100) -> DataFrame:
    """Q1: newest 100 readings of the last 24 h (top-k, TakeOrderedAndProject)."""
    cols = ["machine_id", "temperature", "vibration", "pressure", "event_timestamp",
            "total_anomaly_score"]
    order = [_ts().desc()] + ([F.col("event_id").desc()] if "event_id" in sd.columns else [])
    return prune_recent(sd, as_of, "24h").orderBy(*order).limit(limit).select(*cols)


def machine_summary(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q2: per-machine count, averages, temperature max/min/stddev, last 7 days."""
    return (
        prune_recent(sd, as_of, "7d")
        .groupBy("machine_id")
        .agg(
            F.count(F.lit(1)).alias("total_readings"),
            F.avg("temperature").alias("avg_temperature"),
            F.avg("vibration").alias("avg_vibration"),
            F.avg("pressure").alias("avg_pressure"),
            F.max("temperature").alias("max_temperature"),
            F.min("temperature").alias("min_temperature"),
            F.stddev_samp("temperature").alias("temp_std_dev"),
        )
        .orderBy(F.col("avg_temperature").desc())
    )


def recent_anomalies(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q3: readings with score > 0 in the last 24 h, with severity."""
    return (
        prune_recent(sd, as_of, "24h")
        .filter(_score() > 0)
        .select(
            "machine_id", "temperature", "vibration", "pressure", "total_anomaly_score",
            "event_timestamp", score_level().alias("severity_level"),
        )
        .orderBy(_ts().desc())
    )


def anomaly_trends(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q4: daily anomaly counts and percentage per machine, last 30 days."""
    return (
        prune_recent(sd, as_of, "30d")
        .groupBy("machine_id", _date().alias("date"))
        .agg(F.count(F.lit(1)).alias("total_readings"), _anomalies().alias("anomaly_count"))
        .withColumn("anomaly_percentage", percent(F.col("anomaly_count"), F.col("total_readings")))
        .orderBy("machine_id", "date")
    )


def temp_by_hour(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q5: temperature by hour of day per machine, last 7 days."""
    return (
        prune_recent(sd, as_of, "7d")
        .groupBy("machine_id", _hour().alias("hour_of_day"))
        .agg(
            F.count(F.lit(1)).alias("total_readings"),
            count_when(F.col("temperature") > 80).alias("high_temp_count"),
            F.avg("temperature").alias("avg_temperature"),
            F.max("temperature").alias("max_temperature"),
        )
        .orderBy("machine_id", "hour_of_day")
    )


def hourly_averages(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q6: per machine, date and hour averages, last 7 days."""
    return (
        prune_recent(sd, as_of, "7d")
        .groupBy("machine_id", _date().alias("date"), _hour().alias("hour"))
        .agg(
            F.avg("temperature").alias("avg_temperature"),
            F.avg("vibration").alias("avg_vibration"),
            F.avg("pressure").alias("avg_pressure"),
            F.count(F.lit(1)).alias("reading_count"),
        )
        .orderBy("machine_id", "date", "hour")
    )


def daily_trends(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q7: daily averages and temperature volatility, last 30 days."""
    return (
        prune_recent(sd, as_of, "30d")
        .groupBy("machine_id", _date().alias("date"))
        .agg(
            F.avg("temperature").alias("avg_temperature"),
            F.avg("vibration").alias("avg_vibration"),
            F.avg("pressure").alias("avg_pressure"),
            F.stddev_samp("temperature").alias("temp_volatility"),
            F.count(F.lit(1)).alias("daily_readings"),
        )
        .orderBy("machine_id", "date")
    )


def machine_comparison(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q8: per-machine statistics then anomaly rate, highest rate first."""
    stats = (
        prune_recent(sd, as_of, "7d")
        .groupBy("machine_id")
        .agg(
            F.avg("temperature").alias("avg_temp"),
            F.avg("vibration").alias("avg_vib"),
            F.avg("pressure").alias("avg_pressure"),
            F.stddev_samp("temperature").alias("temp_std"),
            F.count(F.lit(1)).alias("total_readings"),
            _anomalies().alias("anomaly_count"),
        )
    )
    return stats.withColumn(
        "anomaly_rate", percent(F.col("anomaly_count"), F.col("total_readings"))
    ).orderBy(F.col("anomaly_rate").desc())


def _fleet_averages(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    return (
        prune_recent(sd, as_of, "7d")
        .groupBy("machine_id")
        .agg(
            F.avg("temperature").alias("avg_temperature"),
            F.avg("vibration").alias("avg_vibration"),
            F.avg("pressure").alias("avg_pressure"),
            F.count(F.lit(1)).alias("total_readings"),
            _anomalies().alias("anomaly_count"),
        )
    )


def efficiency_ranking(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q9: efficiency rating from the 7-day averages (text order of the rating)."""
    t, v, p = F.col("avg_temperature"), F.col("avg_vibration"), F.col("avg_pressure")
    rating = F.lit("POOR")
    for name, (max_t, max_v, max_p) in reversed(EFFICIENCY_LIMITS.items()):
        rating = F.when((t < max_t) & (v < max_v) & (p < max_p), F.lit(name)).otherwise(rating)
    return (
        _fleet_averages(sd, as_of)
        .withColumn("efficiency_rating", rating)
        .orderBy("efficiency_rating", "avg_temperature")
    )


def attention_needed(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q10: machines with at least one reading of score >= 2 in the last 24 h."""
    return (
        prune_recent(sd, as_of, "24h")
        .groupBy("machine_id")
        .agg(
            F.count(F.lit(1)).alias("total_readings"),
            count_when(_score() >= 2).alias("critical_anomalies"),
            F.avg("temperature").alias("avg_temperature"),
            F.avg("vibration").alias("avg_vibration"),
            F.avg("pressure").alias("avg_pressure"),
            F.max("temperature").alias("max_temperature"),
            F.max("vibration").alias("max_vibration"),
            F.max("pressure").alias("max_pressure"),
        )
        .filter(F.col("critical_anomalies") > 0)
        .orderBy(F.col("critical_anomalies").desc())
    )


def maintenance_trend(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q11: daily averages and change against the previous existing day per machine.

    The window runs over the daily aggregate (machines x days rows), not over
    readings; the three LAGs share one spec and so one Window node.
    """
    daily = (
        prune_recent(sd, as_of, "14d")
        .groupBy("machine_id", _date().alias("date"))
        .agg(
            F.avg("temperature").alias("avg_temp"),
            F.avg("vibration").alias("avg_vib"),
            F.avg("pressure").alias("avg_pressure"),
        )
    )
    w = Window.partitionBy("machine_id").orderBy("date")
    out = daily.withColumns(
        {
            "prev_avg_temp": F.lag("avg_temp", 1).over(w),
            "prev_avg_vib": F.lag("avg_vib", 1).over(w),
            "prev_avg_pressure": F.lag("avg_pressure", 1).over(w),
        }
    )
    return out.withColumns(
        {
            "temp_trend": F.col("avg_temp") - F.col("prev_avg_temp"),
            "vib_trend": F.col("avg_vib") - F.col("prev_avg_vib"),
            "pressure_trend": F.col("avg_pressure") - F.col("prev_avg_pressure"),
        }
    ).orderBy("machine_id", "date")


def peak_hours(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q12: fleet-wide load by hour of day, busiest first."""
    return (
        prune_recent(sd, as_of, "7d")
        .groupBy(_hour().alias("hour_of_day"))
        .agg(
            F.count(F.lit(1)).alias("total_readings"),
            F.avg("temperature").alias("avg_temperature"),
            F.avg("vibration").alias("avg_vibration"),
            F.avg("pressure").alias("avg_pressure"),
            _anomalies().alias("anomaly_count"),
        )
        .orderBy(F.col("total_readings").desc())
    )


def weekly_summary(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q13: weekly (Monday-start) averages and anomaly rate, last 8 weeks."""
    week = F.date_trunc("week", _ts()).cast("timestamp_ntz")
    return (
        prune_recent(sd, as_of, "8w")
        .groupBy("machine_id", week.alias("week_start"))
        .agg(
            F.count(F.lit(1)).alias("weekly_readings"),
            F.avg("temperature").alias("weekly_avg_temp"),
            F.avg("vibration").alias("weekly_avg_vib"),
            F.avg("pressure").alias("weekly_avg_pressure"),
            _anomalies().alias("weekly_anomalies"),
        )
        .withColumn(
            "weekly_anomaly_rate", percent(F.col("weekly_anomalies"), F.col("weekly_readings"))
        )
        .orderBy("machine_id", "week_start")
    )


def completeness(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Share of non-null sensor values per machine, last 7 days."""
    out = (
        prune_recent(sd, as_of, "7d")
        .groupBy("machine_id")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count("temperature").alias("temp_records"),
            F.count("vibration").alias("vib_records"),
            F.count("pressure").alias("pressure_records"),
        )
    )
    total = F.col("total_records")
    return out.withColumns(
        {
            "temp_completeness": percent(F.col("temp_records"), total),
            "vib_completeness": percent(F.col("vib_records"), total),
            "pressure_completeness": percent(F.col("pressure_records"), total),
        }
    ).orderBy("machine_id")


def outliers(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q15: readings outside the outlier ranges in the last 24 h, typed by first match."""
    return (
        prune_recent(sd, as_of, "24h")
        .filter(outlier_predicate())
        .select(
            "machine_id", "temperature", "vibration", "pressure", "event_timestamp",
            outlier_type().alias("outlier_type"),
        )
        .orderBy(_ts().desc())
    )


def energy_efficiency(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q16: energy category from the 7-day temperature and vibration averages."""
    t, v = F.col("avg_temperature"), F.col("avg_vibration")
    category = F.lit("HIGH_ENERGY_USAGE")
    for name, (max_t, max_v) in reversed(ENERGY_LIMITS.items()):
        category = F.when((t < max_t) & (v < max_v), F.lit(name)).otherwise(category)
    return (
        _fleet_averages(sd, as_of)
        .withColumn("efficiency_category", category)
        .orderBy("efficiency_category", "avg_temperature")
    )


def alert_status(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q17: anomalous readings of the last hour, highest score then newest first."""
    return (
        prune_recent(sd, as_of, "1h")
        .filter(_score() > 0)
        .select(
            "machine_id", "temperature", "vibration", "pressure", "total_anomaly_score",
            "event_timestamp", score_level(suffix="_ALERT").alias("alert_level"),
        )
        .orderBy(_score().desc(), _ts().desc())
    )


def alert_frequency(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q18: alert counts by level and last alert time per machine, last 7 days."""
    return (
        prune_recent(sd, as_of, "7d")
        .filter(_score() > 0)
        .groupBy("machine_id")
        .agg(
            F.count(F.lit(1)).alias("total_alerts"),
            F.count(F.when(_score() >= 3, F.lit(1))).alias("critical_alerts"),
            F.count(F.when(_score() == 2, F.lit(1))).alias("high_alerts"),
            F.count(F.when(_score() == 1, F.lit(1))).alias("medium_alerts"),
            F.max(_ts()).alias("last_alert_time"),
        )
        .orderBy(F.col("total_alerts").desc())
    )


def readme_recent_anomalies(sd: DataFrame, as_of: dt.datetime | None = None,
                            limit: int = 100) -> DataFrame:
    """RQ1: newest 100 anomalous readings (``anomaly_detected`` = score > 0), all columns."""
    cols = [c for c in sd.columns if c != "processing_timestamp"]
    out = sd.withColumn("anomaly_detected", _score() > 0).filter(F.col("anomaly_detected"))
    order = [_ts().desc()] + ([F.col("event_id").desc()] if "event_id" in sd.columns else [])
    return out.orderBy(*order).limit(limit).select(*cols, "anomaly_detected")


def readme_trends(sd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """RQ2: average temperature and vibration per machine over the last 24 h."""
    return (
        prune_recent(sd, as_of, "24h")
        .groupBy("machine_id")
        .agg(F.avg("temperature").alias("avg_temp"), F.avg("vibration").alias("avg_vibration"))
    )


CATALOGUE = {
    "recent_readings": recent_readings,
    "machine_summary": machine_summary,
    "recent_anomalies": recent_anomalies,
    "anomaly_trends": anomaly_trends,
    "temp_by_hour": temp_by_hour,
    "hourly_averages": hourly_averages,
    "daily_trends": daily_trends,
    "machine_comparison": machine_comparison,
    "efficiency_ranking": efficiency_ranking,
    "attention_needed": attention_needed,
    "maintenance_trend": maintenance_trend,
    "peak_hours": peak_hours,
    "weekly_summary": weekly_summary,
    "completeness": completeness,
    "outliers": outliers,
    "energy_efficiency": energy_efficiency,
    "alert_status": alert_status,
    "alert_frequency": alert_frequency,
    "readme_recent_anomalies": readme_recent_anomalies,
    "readme_trends": readme_trends,
}
