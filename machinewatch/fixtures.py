"""Adapter from the driver's ``events`` table to sensor readings.

The same mapping is written once for Spark (DataFrame expressions) and once
as DuckDB SQL text, which the oracle queries use as their leading CTE.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed adapter values (see FIXTURES.md section 2): 20 machines, NULL sensor
# values every 97th / 89th / 83rd event, and the readings formulas below.
MACHINE_COUNT = 20
NULL_EVERY = {"temperature": 97, "vibration": 89, "pressure": 83}
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _null_every(event_id: Column, n: int, value: Column) -> Column:
    return F.when(event_id % n == 0, F.lit(None).cast("double")).otherwise(value)


def events_to_readings(events: DataFrame) -> DataFrame:
    """Project ``events`` onto the reading model (one narrow Project, no shuffle)."""
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").try_cast("int")
    is_error = F.col("event_type") == F.lit("error")
    temperature = F.lit(15.0) + F.lit(0.9) * F.col("value")
    vibration = (k - F.lit(2)) / F.lit(40.0) * F.when(is_error, F.lit(2.5)).otherwise(F.lit(1.0))
    pressure = (
        F.lit(40) + (eid * F.lit(7919)) % F.lit(85) + (eid * F.lit(104729)) % F.lit(86)
    ).cast("double")
    return events.select(
        eid.alias("event_id"),
        F.concat(
            F.lit("MCH"), F.lpad((F.col("user_id") % MACHINE_COUNT).cast("string"), 3, "0")
        ).alias("machine_id"),
        F.col("ts").alias("event_timestamp"),
        F.unix_timestamp(F.col("ts")).alias("timestamp"),
        _null_every(eid, NULL_EVERY["temperature"], temperature).alias("temperature"),
        _null_every(eid, NULL_EVERY["vibration"], vibration).alias("vibration"),
        _null_every(eid, NULL_EVERY["pressure"], pressure).alias("pressure"),
        F.when(is_error, F.lit(1)).otherwise(F.lit(0)).alias("label"),
    )


def load_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_readings(read_table(spark, sf_dir, "events"))


# DuckDB text of the same adapter, used as the first CTE of every oracle query.
READINGS_SQL = """readings AS (
    SELECT
        event_id,
        'MCH' || lpad(cast(user_id % 20 AS varchar), 3, '0') AS machine_id,
        ts AS event_timestamp,
        cast(floor(epoch(ts)) AS bigint) AS "timestamp",
        CASE WHEN event_id % 97 = 0 THEN NULL ELSE 15e0 + 0.9e0 * value END AS temperature,
        CASE WHEN event_id % 89 = 0 THEN NULL
             ELSE (cast(props->>'k' AS int) - 2) / 40e0
                  * (CASE WHEN event_type = 'error' THEN 2.5e0 ELSE 1e0 END) END AS vibration,
        CASE WHEN event_id % 83 = 0 THEN NULL
             ELSE cast(40 + (event_id * 7919) % 85 + (event_id * 104729) % 86 AS double) END
             AS pressure,
        CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label
    FROM events
)"""

# The processed ``sensor_data`` view: readings + ratios + flags + score + date parts.
SENSOR_DATA_SQL = """sensor_data AS (
    SELECT *,
        is_anomaly_temp + is_anomaly_vib + is_anomaly_pressure AS total_anomaly_score
    FROM (
        SELECT *,
            temperature / nullif(vibration + 0.001, 0) AS temp_vib_ratio,
            pressure / nullif(temperature + 0.001, 0) AS pressure_temp_ratio,
            CASE WHEN temperature > 80 THEN 1 ELSE 0 END AS is_anomaly_temp,
            CASE WHEN vibration > 2.0 THEN 1 ELSE 0 END AS is_anomaly_vib,
            CASE WHEN pressure > 150 THEN 1 ELSE 0 END AS is_anomaly_pressure,
            cast(year(event_timestamp) AS int) AS "year",
            cast(month(event_timestamp) AS int) AS "month",
            cast(day(event_timestamp) AS int) AS "day",
            cast(hour(event_timestamp) AS int) AS "hour"
        FROM readings
    ) s
)"""

AS_OF_SQL = "(SELECT max(ts) FROM events)"


def with_ctes(body: str, *ctes: str) -> str:
    parts = [READINGS_SQL, *ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


def sensor_sql(body: str, *ctes: str) -> str:
    """Oracle text over the ``sensor_data`` CTE."""
    return with_ctes(body, SENSOR_DATA_SQL, *ctes)
