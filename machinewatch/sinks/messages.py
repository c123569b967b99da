"""Message-shaped outputs: keyed re-publish (S12), alerts (S15), metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from machinewatch.schema import (
    ALERT_SEVERITY,
    ALERT_SUBJECT_PREFIX,
    ALERT_TYPE,
    METRIC_DIMENSION,
    UNKNOWN_MACHINE,
)

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def republish_keyed(df: DataFrame, key: str = "machine_id") -> DataFrame:
    """``(key, value)`` records, value = the whole row as JSON (a Kafka-style sink shape)."""
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def alert_messages(scored: DataFrame, time_col: str = "event_timestamp") -> DataFrame:
    """S15 + P12: one alert per reading predicted anomalous (``prediction = 1``).

    ``message`` is the JSON alert body (nested ``sensor_data``); ``subject``
    the notification subject line.
    """
    machine = F.coalesce(F.col("machine_id"), F.lit(UNKNOWN_MACHINE))
    sensor = F.struct("temperature", "vibration", "pressure")
    alerts = scored.filter(F.col("prediction") == 1).select(
        *[c for c in ("event_id",) if c in scored.columns],
        F.lit(ALERT_TYPE).alias("alert_type"),
        machine.alias("machine_id"),
        F.date_format(F.col(time_col), ISO_FORMAT).alias("alert_timestamp"),
        sensor.alias("sensor_data"),
        F.col("prediction").cast("int").alias("prediction"),
        F.lit(ALERT_SEVERITY).alias("severity"),
    )
    return alerts.withColumns({
        "subject": F.concat(F.lit(ALERT_SUBJECT_PREFIX), F.col("machine_id")),
        "message": F.to_json(F.struct("alert_type", "machine_id",
                                      F.col("alert_timestamp").alias("timestamp"),
                                      "sensor_data", "prediction", "severity")),
    })


def metrics_long(scored: DataFrame, duration_col: str | None = None) -> DataFrame:
    """One metric row per reading and measure (long form), dimension MachineId."""
    def metric(name: str, value: Column, unit: str = "None") -> Column:
        return F.struct(F.lit(name).alias("metric_name"), value.cast("double").alias("value"),
                        F.lit(unit).alias("unit"))

    items = [
        metric("Temperature", F.col("temperature")),
        metric("Vibration", F.col("vibration")),
        metric("Pressure", F.col("pressure")),
        metric("AnomalyPrediction", F.col("prediction")),
    ]
    if duration_col:
        items.append(metric("ProcessingDuration", F.col(duration_col), "Milliseconds"))
    keep = [c for c in ("event_id",) if c in scored.columns]
    machine = F.coalesce(F.col("machine_id"), F.lit(UNKNOWN_MACHINE))
    return scored.select(*keep, machine.alias("machine_id"), F.inline(F.array(*items))).select(
        *keep, "metric_name", "value", "unit",
        F.lit(METRIC_DIMENSION).alias("dimension_name"), F.col("machine_id").alias("dimension_value"))
