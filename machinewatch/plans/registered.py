"""Registrations of the non-catalogue operators with their DuckDB oracle text.

Importing this module fills the registry; every query reads ``events``
(through the readings adapter) or data Spark derives from it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from machinewatch.fixtures import events_to_readings, load_readings, read_table, sensor_sql, with_ctes
from machinewatch.functions.features import date_part_columns, edge_rule, flag_columns, ratio_columns
from machinewatch.operators import enrich, stats
from machinewatch.plans import etl
from machinewatch.plans.registry import register, sensor_data
from machinewatch.schema import SENSORS
from machinewatch.session import scratch_path

# ---------------------------------------------------------------------------
# SQL fragments shared by several oracle texts
# ---------------------------------------------------------------------------
SENSOR_COLS = "temperature, vibration, pressure"
VALID_SQL = """valid AS (
    SELECT *, cast(event_timestamp AS date) AS batch_date FROM readings
    WHERE temperature IS NOT NULL AND vibration IS NOT NULL AND pressure IS NOT NULL
)"""
LAG_SQL = """lagged AS (
    SELECT *,
        lag(temperature, 1) OVER w AS temp_lag_1,
        lag(vibration, 1) OVER w AS vib_lag_1,
        lag(pressure, 1) OVER w AS pressure_lag_1,
        temperature - lag(temperature, 1) OVER w AS temp_diff,
        vibration - lag(vibration, 1) OVER w AS vib_diff,
        pressure - lag(pressure, 1) OVER w AS pressure_diff
    FROM sensor_data
    WINDOW w AS (PARTITION BY machine_id ORDER BY event_timestamp, event_id)
)"""


def _stats_sql(prefix: str, col: str) -> str:
    return (f"avg({col}) AS {prefix}_mean, "
            f"CASE WHEN count({col}) > 1 THEN stddev_samp({col}) ELSE 0e0 END AS {prefix}_std, "
            f"min({col}) AS {prefix}_min, max({col}) AS {prefix}_max")


BATCH_STATS_SQL = ", ".join(
    _stats_sql(p, c) for p, c in (("temp", "temperature"), ("vib", "vibration"), ("pressure", "pressure"))
)


def _trend_sql(name: str, col: str, delta: str) -> str:
    return (f"CASE WHEN n < 3 THEN NULL WHEN last_{col} > first_{col} + {delta} THEN 'increasing' "
            f"WHEN last_{col} < first_{col} - {delta} THEN 'decreasing' ELSE 'stable' END AS {name}")


TRENDS_CTE = """ordered AS (
    SELECT *,
        row_number() OVER (PARTITION BY machine_id, batch_date ORDER BY event_timestamp, event_id) AS rn_first,
        row_number() OVER (PARTITION BY machine_id, batch_date ORDER BY event_timestamp DESC, event_id DESC) AS rn_last,
        count(*) OVER (PARTITION BY machine_id, batch_date) AS n
    FROM valid
),
ends AS (
    SELECT machine_id, batch_date, max(n) AS n,
        max(CASE WHEN rn_first = 1 THEN temperature END) AS first_temperature,
        max(CASE WHEN rn_last = 1 THEN temperature END) AS last_temperature,
        max(CASE WHEN rn_first = 1 THEN vibration END) AS first_vibration,
        max(CASE WHEN rn_last = 1 THEN vibration END) AS last_vibration,
        max(CASE WHEN rn_first = 1 THEN pressure END) AS first_pressure,
        max(CASE WHEN rn_last = 1 THEN pressure END) AS last_pressure
    FROM ordered GROUP BY machine_id, batch_date
),
trends AS (
    SELECT machine_id, batch_date,
        CASE WHEN n < 3 THEN 'insufficient_data' END AS trend,
        """ + ",\n        ".join([
    _trend_sql("temp_trend", "temperature", "5"),
    _trend_sql("vib_trend", "vibration", "0.5"),
    _trend_sql("pressure_trend", "pressure", "10"),
]) + """
    FROM ends
)"""


def valid_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with all three sensor values, grouped into daily micro-batches."""
    return (load_readings(spark, sf_dir).dropna(subset=list(SENSORS))
            .withColumn("batch_date", F.to_date("event_timestamp")))


BATCH_KEYS = ("machine_id", "batch_date")

# ---------------------------------------------------------------------------
# Row-level projections
# ---------------------------------------------------------------------------


@register("event_time", with_ctes("""
SELECT event_id, "timestamp", event_timestamp,
       cast(to_timestamp("timestamp") AT TIME ZONE 'UTC' AS timestamp) AS event_time_from_epoch
FROM readings"""))
def q_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time recomputed from epoch seconds (equals the source time truncated to seconds)."""
    r = load_readings(spark, sf_dir).select("event_id", "timestamp", "event_timestamp")
    derived = enrich.event_time(r.withColumnRenamed("event_timestamp", "source_time"))
    return derived.select("event_id", "timestamp", F.col("source_time").alias("event_timestamp"),
                          F.col("event_timestamp").alias("event_time_from_epoch"))


@register("ratio_features", with_ctes("""
SELECT event_id, temperature / nullif(vibration + 0.001, 0) AS temp_vib_ratio,
       pressure / nullif(temperature + 0.001, 0) AS pressure_temp_ratio
FROM readings"""))
def q_ratio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two ratio features."""
    return load_readings(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in ratio_columns().items()])


@register("rule_flags", with_ctes("""
SELECT event_id,
       CASE WHEN temperature > 80 THEN 1 ELSE 0 END AS is_anomaly_temp,
       CASE WHEN vibration > 2.0 THEN 1 ELSE 0 END AS is_anomaly_vib,
       CASE WHEN pressure > 150 THEN 1 ELSE 0 END AS is_anomaly_pressure
FROM readings"""))
def q_rule_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three threshold flags (NULL reading -> 0)."""
    return load_readings(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in flag_columns().items()])


@register("anomaly_score", sensor_sql("""
SELECT total_anomaly_score, count(*) AS readings FROM sensor_data GROUP BY total_anomaly_score"""))
def q_anomaly_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: distribution of the summed rule score."""
    return sensor_data(spark, sf_dir).groupBy("total_anomaly_score").agg(
        F.count(F.lit(1)).alias("readings"))


@register("date_parts", with_ctes("""
SELECT event_id, cast(year(event_timestamp) AS int) AS "year",
       cast(month(event_timestamp) AS int) AS "month",
       cast(day(event_timestamp) AS int) AS "day", cast(hour(event_timestamp) AS int) AS "hour"
FROM readings"""))
def q_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition date parts."""
    return load_readings(spark, sf_dir).select(
        "event_id", *[c.alias(n) for n, c in date_part_columns().items()])


@register("edge_rule", with_ctes("""
SELECT event_id, machine_id, "timestamp", temperature, vibration, pressure,
       CASE WHEN temperature > 85 OR vibration > 2.0 OR pressure > 110 THEN 1 ELSE 0 END AS anomaly_score
FROM readings"""))
def q_edge_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any-of edge rule."""
    r = load_readings(spark, sf_dir)
    return r.select("event_id", "machine_id", "timestamp", *SENSORS, edge_rule().alias("anomaly_score"))


@register("lag_features", sensor_sql("""
SELECT event_id, machine_id, event_timestamp, temp_lag_1, vib_lag_1, pressure_lag_1,
       temp_diff, vib_diff, pressure_diff
FROM lagged""", LAG_SQL))
def q_lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + P21: previous reading per machine and differences, over ranges of (machine, time)."""
    out = enrich.lag_features(sensor_data(spark, sf_dir))
    return out.select("event_id", "machine_id", "event_timestamp",
                      "temp_lag_1", "vib_lag_1", "pressure_lag_1",
                      "temp_diff", "vib_diff", "pressure_diff")


@register("feature_matrix", with_ctes("""
SELECT event_id, machine_id, temperature, vibration, pressure,
       temperature / nullif(vibration + 0.001, 0) AS temp_vib_ratio,
       pressure / nullif(temperature + 0.001, 0) AS pressure_temp_ratio,
       cast(label AS double) AS label
FROM readings"""))
def q_feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five model features in fixed order plus the label."""
    return enrich.feature_matrix(load_readings(spark, sf_dir))


@register("lenient_features", with_ctes("""
SELECT event_id, coalesce(temperature, 0e0) AS temperature, coalesce(vibration, 0e0) AS vibration,
       coalesce(pressure, 0e0) AS pressure,
       coalesce(temperature, 0e0) / nullif(coalesce(vibration, 0e0) + 0.001, 0) AS temp_vib_ratio,
       coalesce(pressure, 0e0) / nullif(coalesce(temperature, 0e0) + 0.001, 0) AS pressure_temp_ratio
FROM readings"""))
def q_lenient_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 lenient: missing sensor -> 0.0 before the ratios."""
    r = load_readings(spark, sf_dir).select("event_id", *SENSORS)
    return enrich.lenient_features(r)


# ---------------------------------------------------------------------------
# Aggregations (A1-A4, A6, S20) and per-group ordered work
# ---------------------------------------------------------------------------
_A1_SQL = sensor_sql("""
SELECT machine_id, "year", "month", "day", "hour",
       avg(temperature) AS avg_temperature, avg(vibration) AS avg_vibration,
       avg(pressure) AS avg_pressure,
       stddev_samp(temperature) AS std_temperature, stddev_samp(vibration) AS std_vibration,
       stddev_samp(pressure) AS std_pressure,
       max(temperature) AS max_temperature, min(temperature) AS min_temperature,
       max(vibration) AS max_vibration, min(vibration) AS min_vibration,
       max(pressure) AS max_pressure, min(pressure) AS min_pressure,
       count(*) AS record_count, cast(sum(total_anomaly_score) AS bigint) AS anomaly_count
FROM sensor_data GROUP BY machine_id, "year", "month", "day", "hour\"""")

_A2_BODY = """
SELECT machine_id, "year", "month", "day", count(*) AS total_records,
       cast(sum(CASE WHEN total_anomaly_score > 0 THEN 1 ELSE 0 END) AS bigint) AS anomaly_records,
       avg(temperature) AS avg_temperature, avg(vibration) AS avg_vibration,
       avg(pressure) AS avg_pressure, max(temperature) AS max_temperature,
       min(temperature) AS min_temperature
FROM sensor_data GROUP BY machine_id, "year", "month", "day\""""
_A2_SQL = sensor_sql(_A2_BODY)
_A3_SQL = sensor_sql("""
SELECT machine_id, "year", "month",
       avg(avg_temperature) AS monthly_avg_temp, avg(avg_vibration) AS monthly_avg_vib,
       avg(avg_pressure) AS monthly_avg_pressure,
       cast(sum(anomaly_records) AS bigint) AS monthly_anomalies,
       cast(sum(total_records) AS bigint) AS monthly_total_records,
       cast(sum(anomaly_records) AS double) / cast(sum(total_records) AS double) * 100e0
           AS anomaly_percentage
FROM daily GROUP BY machine_id, "year", "month\"""", "daily AS (" + _A2_BODY + ")")


@register("machine_stats", _A1_SQL)
def q_machine_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: hourly machine statistics."""
    return stats.machine_stats(sensor_data(spark, sf_dir))


@register("anomaly_summary", _A2_SQL)
def q_anomaly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: daily anomaly summary."""
    return stats.anomaly_summary(sensor_data(spark, sf_dir))


@register("machine_performance", _A3_SQL)
def q_machine_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: monthly performance as an aggregate of the daily summary."""
    return stats.machine_performance(stats.anomaly_summary(sensor_data(spark, sf_dir)))


@register("run_stats", sensor_sql("""
SELECT count(*) AS total_records, count(DISTINCT machine_id) AS unique_machines,
       cast(sum(CASE WHEN total_anomaly_score > 0 THEN 1 ELSE 0 END) AS bigint) AS anomaly_records
FROM sensor_data"""))
def q_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run statistics in one aggregate."""
    return stats.run_stats(sensor_data(spark, sf_dir))


@register("label_distribution", with_ctes("""
SELECT label, count(*) AS "count" FROM readings GROUP BY label"""))
def q_label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class balance of the training label."""
    return stats.label_distribution(load_readings(spark, sf_dir))


@register("batch_stats", with_ctes(f"""
SELECT machine_id, batch_date, count(*) AS batch_records, {BATCH_STATS_SQL}
FROM valid GROUP BY machine_id, batch_date""", VALID_SQL))
def q_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: micro-batch statistics per machine and daily batch."""
    return stats.batch_stats(valid_readings(spark, sf_dir), BATCH_KEYS)


@register("detect_trends", with_ctes("""
SELECT machine_id, batch_date, trend, temp_trend, vib_trend, pressure_trend FROM trends""",
                                     VALID_SQL, TRENDS_CTE))
def q_detect_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-versus-last trend per machine and daily batch."""
    return stats.detect_trends(valid_readings(spark, sf_dir), BATCH_KEYS)


@register("latest_reading", with_ctes("""
SELECT machine_id, event_id, event_timestamp, "timestamp", temperature, vibration, pressure, label
FROM (SELECT *, row_number() OVER (PARTITION BY machine_id
                                   ORDER BY event_timestamp DESC, event_id DESC) AS rn
      FROM readings) t WHERE rn = 1"""))
def q_latest_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest reading per machine."""
    return stats.latest_reading(load_readings(spark, sf_dir), ["machine_id"])


@register("attach_batch_stats", with_ctes(f"""
SELECT v.machine_id, v.batch_date, v.event_id, v.event_timestamp, v."timestamp",
       v.temperature, v.vibration, v.pressure, v.label,
       {", ".join(f"g.{c}" for c in stats.STAT_COLUMNS)},
       {", ".join(f"g.{c}" for c in stats.TREND_COLUMNS)}
FROM valid v LEFT JOIN (
    SELECT s.*, t.trend, t.temp_trend, t.vib_trend, t.pressure_trend, l.event_id AS last_id
    FROM (SELECT machine_id, batch_date, count(*) AS batch_records, {BATCH_STATS_SQL}
          FROM valid GROUP BY machine_id, batch_date) s
    JOIN trends t USING (machine_id, batch_date)
    JOIN (SELECT machine_id, batch_date, event_id FROM ordered WHERE rn_last = 1) l
      USING (machine_id, batch_date)
    WHERE s.batch_records > 1
) g ON v.machine_id = g.machine_id AND v.batch_date = g.batch_date AND v.event_id = g.last_id""",
                                          VALID_SQL, TRENDS_CTE))
def q_attach_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch statistics and trends on the latest reading of each daily batch."""
    return stats.attach_batch_stats(valid_readings(spark, sf_dir), BATCH_KEYS)


# ---------------------------------------------------------------------------
# ETL sinks (S6-S8, S5): write the tables, read them back
# ---------------------------------------------------------------------------
def etl_output(spark: SparkSession, sf_dir: str) -> etl.EtlPaths:
    """Run the batch ETL into a new scratch folder."""
    root = scratch_path(spark, f"etl-{uuid.uuid4().hex[:12]}")
    return etl.run_etl(spark, load_readings(spark, sf_dir), root, processing_time=False)["paths"]


@register("sink_processed", sensor_sql("SELECT * FROM lagged", LAG_SQL))
def q_sink_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed rows written partitioned by year/month/day/hour and read back."""
    return spark.read.parquet(etl_output(spark, sf_dir).processed)


@register("sink_machine_stats", _A1_SQL)
def q_sink_machine_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly statistics written partitioned and read back."""
    return spark.read.parquet(etl_output(spark, sf_dir).machine_statistics)


@register("sink_summary", _A2_SQL)
def q_sink_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily summary written with overwrite and read back."""
    return spark.read.parquet(etl_output(spark, sf_dir).anomaly_summary)


@register("sink_performance", _A3_SQL)
def q_sink_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly performance (built from the stored daily summary) read back."""
    return spark.read.parquet(etl_output(spark, sf_dir).machine_performance)


@register("scan_parquet", sensor_sql("""
SELECT machine_id, cast(event_timestamp AS date) AS date, count(*) AS readings
FROM sensor_data WHERE event_timestamp >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY
GROUP BY machine_id, cast(event_timestamp AS date)"""))
def q_scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4/S5 + prune_recent: the stored table as view ``sensor_data``, last 7 days by SQL.

    The day predicate added by ``prune_recent`` prunes whole partitions.
    """
    from machinewatch.functions.time import prune_recent, resolve_as_of_stored

    stored = spark.read.parquet(etl_output(spark, sf_dir).processed)
    as_of = resolve_as_of_stored(stored)
    prune_recent(stored, as_of, "7d").createOrReplaceTempView("sensor_data_recent")
    return spark.sql("""
        SELECT machine_id, to_date(event_timestamp) AS date, count(*) AS readings
        FROM sensor_data_recent GROUP BY machine_id, to_date(event_timestamp)""")


@register("sql_views", with_ctes("""
SELECT machine_id, cast(year(event_timestamp) AS int) AS "year", cast(month(event_timestamp) AS int) AS "month",
       cast(day(event_timestamp) AS int) AS "day", count(*) AS readings, count(*) AS summarized
FROM readings GROUP BY 1, 2, 3, 4"""))
def q_sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the documented views ``sensor_data`` and ``anomaly_summary`` of the written tables."""
    etl.register_views(spark, etl_output(spark, sf_dir))
    return spark.sql("""
        SELECT r.machine_id, r.year, r.month, r.day, r.readings, s.total_records AS summarized
        FROM (SELECT machine_id, year, month, day, count(*) AS readings FROM sensor_data
              GROUP BY machine_id, year, month, day) r
        JOIN anomaly_summary s ON s.machine_id = r.machine_id AND s.year = r.year AND s.month = r.month AND s.day = r.day""")


@register("result_export", _A3_SQL)
def q_result_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query's result exported to a folder of its own and read back."""
    from machinewatch.sinks.files import write_table

    path = scratch_path(spark, f"result-{uuid.uuid4().hex[:12]}")
    write_table(stats.machine_performance(stats.anomaly_summary(sensor_data(spark, sf_dir))), path, sort_cols=stats.MONTH_KEYS)
    return spark.read.parquet(path)


@register("lake_table", with_ctes(f"""
SELECT machine_id, "timestamp", cast(year(event_timestamp) AS int) AS "year", cast(hour(event_timestamp) AS int) AS "hour"
FROM readings"""))
def q_lake_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON lake as a catalog table with its discovered schema and partitions."""
    from machinewatch.sinks.files import PARTITION_KEYS

    path, name = scratch_path(spark, f"lake-{uuid.uuid4().hex[:12]}"), f"sensor_data_raw_{uuid.uuid4().hex[:12]}"
    landed = rawsrc.raw_json(load_readings(spark, sf_dir)).withColumns(dict(date_part_columns()))
    landed.select("raw", *PARTITION_KEYS).hint("rebalance", *PARTITION_KEYS).write.partitionBy(*PARTITION_KEYS).text(path)
    rawsrc.register_lake_table(spark, path, name)
    return spark.table(name).select("machine_id", "timestamp", "year", "hour")


# ---------------------------------------------------------------------------
# Raw sources, decoding, validation, dead letters
# ---------------------------------------------------------------------------
from machinewatch.operators import quality  # noqa: E402
from machinewatch.sinks import messages  # noqa: E402
from machinewatch.sinks.files import write_json  # noqa: E402
from machinewatch.sources import raw as rawsrc  # noqa: E402

READING_FIELDS = ("machine_id", "timestamp", "temperature", "vibration", "pressure")
_READING_FIELDS_SQL = 'machine_id, "timestamp", temperature, vibration, pressure'

REJECT_SQL = """CASE
    WHEN event_id % 103 = 0 THEN 'missing_field:machine_id'
    WHEN event_id % 101 <> 0 AND temperature IS NULL THEN 'missing_field:temperature'
    WHEN vibration IS NULL THEN 'missing_field:vibration'
    WHEN pressure IS NULL THEN 'missing_field:pressure'
    WHEN event_id % 109 = 0 THEN 'missing_field:timestamp'
    WHEN event_id % 101 = 0 THEN 'invalid_type:temperature'
    WHEN event_id % 107 = 0 THEN 'invalid_type:timestamp'
    END"""
BAD_ROWS_SQL = f"""bad AS (
    SELECT event_id,
        CASE WHEN event_id % 103 = 0 THEN NULL ELSE machine_id END AS machine_id,
        CASE WHEN event_id % 109 = 0 OR event_id % 107 = 0 THEN NULL ELSE "timestamp" END AS "timestamp",
        CASE WHEN event_id % 101 = 0 THEN NULL ELSE temperature END AS temperature,
        vibration, pressure,
        {REJECT_SQL} AS reject_reason
    FROM readings
)"""


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = rawsrc.raw_bad(load_readings(spark, sf_dir))
    return quality.validate_readings(rawsrc.parse_raw(raw))


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("validate_readings", with_ctes(f"""
SELECT event_id, {_READING_FIELDS_SQL}, reject_reason IS NULL AS is_valid, reject_reason
FROM bad""", BAD_ROWS_SQL))
def q_validate_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required fields and types with a reject reason per row."""
    return _validated(spark, sf_dir).select("event_id", *READING_FIELDS, "is_valid", "reject_reason")


@register("dead_letter", with_ctes("""
SELECT event_id, reject_reason FROM bad WHERE reject_reason IS NOT NULL""", BAD_ROWS_SQL))
def q_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows written to an ``errors/`` prefix (JSON lines, gzip) and read back."""
    path = _scratch(spark, "errors")
    write_json(quality.dead_letter_rows(_validated(spark, sf_dir)), path, compression="gzip")
    return spark.read.schema("event_id bigint, raw string, reject_reason string, routed_at timestamp") \
        .json(path).select("event_id", "reject_reason")


@register("range_warnings", with_ctes("""
SELECT event_id, concat_ws(',',
        CASE WHEN temperature IS NOT NULL AND NOT (temperature BETWEEN 0 AND 200) THEN 'temperature_out_of_range' END,
        CASE WHEN vibration IS NOT NULL AND NOT (vibration BETWEEN 0 AND 10) THEN 'vibration_out_of_range' END,
        CASE WHEN pressure IS NOT NULL AND NOT (pressure BETWEEN 0 AND 200) THEN 'pressure_out_of_range' END)
        AS warnings,
    (CASE WHEN temperature IS NOT NULL AND NOT (temperature BETWEEN 0 AND 200) THEN 1 ELSE 0 END
     + CASE WHEN vibration IS NOT NULL AND NOT (vibration BETWEEN 0 AND 10) THEN 1 ELSE 0 END
     + CASE WHEN pressure IS NOT NULL AND NOT (pressure BETWEEN 0 AND 200) THEN 1 ELSE 0 END)
        AS warning_count
FROM readings"""))
def q_range_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: plausible-range warnings (rows are kept)."""
    r = load_readings(spark, sf_dir).select("event_id", *SENSORS)
    return quality.range_warnings(r).select("event_id", "warnings", "warning_count")


@register("decode_payload", with_ctes(f"SELECT event_id, {_READING_FIELDS_SQL} FROM readings"))
def q_decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """base64 or plain-body payloads decoded and parsed."""
    records = rawsrc.stream_records(rawsrc.raw_json(load_readings(spark, sf_dir)))
    decoded = rawsrc.decode_payload(records)
    from machinewatch.schema import READING_SCHEMA
    return decoded.select("event_id", F.from_json("raw", READING_SCHEMA).alias("r")).select(
        "event_id", *[F.col(f"r.{c}").alias(c) for c in READING_FIELDS])


@register("scan_json", with_ctes(f"""
SELECT {_READING_FIELDS_SQL}, cast(year(event_timestamp) AS int) AS "year",
       cast(month(event_timestamp) AS int) AS "month", cast(day(event_timestamp) AS int) AS "day",
       cast(hour(event_timestamp) AS int) AS "hour"
FROM readings"""))
def q_scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings landed as gzip JSON lines under year=/month=/day=/hour=, scanned back."""
    path = _scratch(spark, "lake")
    landed = rawsrc.raw_json(load_readings(spark, sf_dir)).withColumns(
        {k: c for k, c in date_part_columns().items()})
    from machinewatch.sinks.files import PARTITION_KEYS
    (landed.select("raw", *PARTITION_KEYS).hint("rebalance", *PARTITION_KEYS)
        .write.mode("overwrite").partitionBy(*PARTITION_KEYS)
        .option("compression", "gzip").text(path))
    return rawsrc.read_raw(spark, path)


@register("scan_concat_json", with_ctes(f"SELECT {_READING_FIELDS_SQL} FROM readings"))
def q_scan_concat_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: ten JSON objects per line without separator, split and parsed."""
    path = _scratch(spark, "concat")
    raw = rawsrc.raw_json(load_readings(spark, sf_dir))
    lines = raw.groupBy((F.col("event_id") / 10).cast("bigint").alias("line")).agg(
        F.concat_ws("", F.collect_list("raw")).alias("value"))
    lines.select("value").write.mode("overwrite").text(path)
    return rawsrc.read_concat_json(spark, path)


@register("crawl_schema", """
SELECT * FROM (VALUES ('machine_id', 'string', false), ('pressure', 'double', false),
    ('temperature', 'double', false), ('timestamp', 'bigint', false), ('vibration', 'double', false),
    ('year', 'int', true), ('month', 'int', true), ('day', 'int', true), ('hour', 'int', true))
    AS t(column_name, data_type, is_partition)
WHERE (SELECT count(*) FROM events) > 0""")
def q_crawl_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema inferred from the landed JSON lake (every file sampled)."""
    path = _scratch(spark, "crawl")
    landed = rawsrc.raw_json(load_readings(spark, sf_dir)).withColumns(date_part_columns())
    landed.select("raw", "year", "month", "day", "hour").write.mode("overwrite") \
        .partitionBy("year", "month", "day", "hour").text(path)
    return rawsrc.crawl_schema(spark, path)


@register("enrich_stream", with_ctes(f"""
SELECT event_id, {_READING_FIELDS_SQL},
       temperature / nullif(vibration + 0.001, 0) AS temp_vib_ratio,
       pressure / nullif(temperature + 0.001, 0) AS pressure_temp_ratio,
       '1.0' AS data_version, "timestamp" IS NULL AS timestamp_filled
FROM readings"""))
def q_enrich_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment of decoded payloads; an absent timestamp is filled with the current time.

    The filled value is wall-clock dependent, so the output shows which rows
    were filled (the adapter's timestamps are never absent).
    """
    raw = rawsrc.raw_json(load_readings(spark, sf_dir))
    parsed = rawsrc.parse_raw(raw)
    had_ts = F.array_contains(F.json_object_keys("raw"), F.lit("timestamp"))
    out = enrich.enrich_stream(parsed.withColumn("_had_ts", had_ts))
    return out.select(
        "event_id", "machine_id", F.col("timestamp").try_cast("bigint").alias("timestamp"),
        *[F.col(s).try_cast("double").alias(s) for s in SENSORS],
        "temp_vib_ratio", "pressure_temp_ratio", "data_version",
        (~F.col("_had_ts")).alias("timestamp_filled"))


# ---------------------------------------------------------------------------
# Messages (S12, S15, S16, P24) over rule predictions (score >= 2)
# ---------------------------------------------------------------------------
PRED_SQL = """pred AS (
    SELECT *, CASE WHEN total_anomaly_score >= 2 THEN 1 ELSE 0 END AS prediction
    FROM sensor_data
    WHERE temperature IS NOT NULL AND vibration IS NOT NULL AND pressure IS NOT NULL
)"""


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``predictions`` fixture: validated readings, rule score >= 2 as the prediction."""
    sd = sensor_data(spark, sf_dir).dropna(subset=list(SENSORS))
    return sd.withColumn("prediction", F.when(F.col("total_anomaly_score") >= 2, 1).otherwise(0))


@register("alert_messages", sensor_sql("""
SELECT event_id, 'anomaly_detected' AS alert_type, coalesce(machine_id, 'unknown') AS machine_id,
       strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS alert_timestamp,
       temperature, vibration, pressure, prediction, 'high' AS severity,
       'IoT Anomaly Alert - Machine ' || coalesce(machine_id, 'unknown') AS subject, true AS message_agrees
FROM pred WHERE prediction = 1""", PRED_SQL))
def q_alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert records (message JSON kept in ``message``; flattened fields for checking)."""
    alerts = messages.alert_messages(rule_predictions(spark, sf_dir))
    body = F.from_json("message", "alert_type string, machine_id string, timestamp string, sensor_data "
                       "struct<temperature: double, vibration: double, pressure: double>, prediction int, severity string")
    agrees = F.struct(*[body[c] for c in ("alert_type", "machine_id", "timestamp", "sensor_data", "prediction", "severity")]
                      ) == F.struct("alert_type", "machine_id", "alert_timestamp", "sensor_data", "prediction", "severity")
    return alerts.select("event_id", "alert_type", "machine_id", "alert_timestamp",
                         "sensor_data.*", "prediction", "severity", "subject", agrees.alias("message_agrees"))


@register("metrics_long", sensor_sql("""
SELECT event_id, 'Temperature' AS metric_name, temperature AS value, 'None' AS unit,
       'MachineId' AS dimension_name, machine_id AS dimension_value FROM pred
UNION ALL SELECT event_id, 'Vibration', vibration, 'None', 'MachineId', machine_id FROM pred
UNION ALL SELECT event_id, 'Pressure', pressure, 'None', 'MachineId', machine_id FROM pred
UNION ALL SELECT event_id, 'AnomalyPrediction', cast(prediction AS double), 'None', 'MachineId', machine_id
FROM pred
UNION ALL SELECT event_id, 'ProcessingDuration', cast(event_id % 1000 AS double), 'Milliseconds', 'MachineId', machine_id
FROM pred""", PRED_SQL))
def q_metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric datapoints in long form (one row per reading and measure)."""
    timed = rule_predictions(spark, sf_dir).withColumn("duration_ms", (F.col("event_id") % 1000).cast("double"))
    return messages.metrics_long(timed, duration_col="duration_ms")


# ---------------------------------------------------------------------------
# Streaming (S9, S13, S23, ST1-ST8): file-source streams over weekly batches
# ---------------------------------------------------------------------------
import datetime as _dt  # noqa: E402

from machinewatch.streaming import sources as stream_sources  # noqa: E402
from machinewatch.streaming import transform as stream_transform  # noqa: E402
from machinewatch.streaming import windows as stream_windows  # noqa: E402

def _week() -> F.Column:
    return F.date_trunc("week", F.col("event_timestamp")).cast("timestamp_ntz")
LATE_EVERY = 50  # every 50th event arrives one batch (week) late


def _with_event_id(raw: DataFrame) -> DataFrame:
    """Stream line = the raw reading JSON with the message id as an extra first key."""
    return raw.withColumn("raw", F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"),
                                           F.lit(","), F.expr("substr(raw, 2)")))


def _arrival_week(df: DataFrame) -> DataFrame:
    shifted = F.when(F.col("event_id") % LATE_EVERY == 0, _week() + F.expr("INTERVAL 7 DAYS")).otherwise(_week())
    return df.withColumn("arrival_week", shifted)


def _run_transform(spark: SparkSession, lines: DataFrame) -> str:
    """Run ST1 over weekly arrivals of ``raw`` lines; return its output root."""
    root = _scratch(spark, "stream-transform")
    paths = stream_transform.TransformPaths(root)
    stream_sources.run_arrivals(lines, root, "week", lambda stream: stream_transform.start_transform(stream, paths))
    return root


def _bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective records that carry a message id."""
    return _with_event_id(rawsrc.raw_bad(load_readings(spark, sf_dir))).withColumn("week", _week())


REDELIVERED_EVERY = 53  # every 53rd record arrives twice


def _device_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as devices send them: five fields, no id, many of equal time, some delivered twice."""
    readings = load_readings(spark, sf_dir).withColumn("timestamp", F.expr("timestamp div 3600 * 3600"))
    again = readings.filter(F.col("event_id") % REDELIVERED_EVERY == 0)
    return rawsrc.raw_json(readings.unionByName(again)).withColumn("week", _week())


ST1_VALID = """(event_id % 103 <> 0 AND event_id % 101 <> 0 AND temperature IS NOT NULL
    AND vibration IS NOT NULL AND pressure IS NOT NULL
    AND NOT (event_id % 107 = 0 AND event_id % 109 <> 0))"""


@register("stream_transform", with_ctes(f"""
SELECT event_id, machine_id, temperature, vibration, pressure,
       temperature / nullif(vibration + 0.001, 0) AS temp_vib_ratio,
       pressure / nullif(temperature + 0.001, 0) AS pressure_temp_ratio, '1.0' AS data_version
FROM readings WHERE {ST1_VALID}"""))
def q_stream_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1: decode, enrich, validate, drop bad rows, deliver (weekly micro-batches of defective input)."""
    root = _run_transform(spark, _bad_lines(spark, sf_dir))
    out = spark.read.parquet(root + "/delivered")
    return out.select("event_id", "machine_id", "temperature", "vibration", "pressure",
                      "temp_vib_ratio", "pressure_temp_ratio", "data_version")


@register("batch_log", with_ctes(f"""
SELECT cast(row_number() OVER (ORDER BY week) - 1 AS bigint) AS batch_id, records,
       processed_records, rejected_records
FROM (SELECT date_trunc('week', event_timestamp) AS week, count(*) AS records,
             count(*) FILTER (WHERE {ST1_VALID}) AS processed_records,
             count(*) FILTER (WHERE NOT {ST1_VALID}) AS rejected_records
      FROM readings GROUP BY 1) w"""))
def q_batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch outcome log of the ST1 run (counts; durations are wall-clock)."""
    root = _run_transform(spark, _bad_lines(spark, sf_dir))
    log = spark.read.json(root + "/batch_log")
    return log.select(F.col("batch_id").cast("bigint").alias("batch_id"),
                      F.col("records").cast("bigint").alias("records"),
                      F.col("processed_records").cast("bigint").alias("processed_records"),
                      F.col("rejected_records").cast("bigint").alias("rejected_records"))


_DEVICE_CTES = (f"""valid AS (
    SELECT machine_id, cast(floor("timestamp" / 3600) * 3600 AS bigint) AS "timestamp", temperature, vibration, pressure,
           date_trunc('week', event_timestamp) AS batch_date
    FROM (SELECT * FROM readings UNION ALL SELECT * FROM readings WHERE event_id % {REDELIVERED_EVERY} = 0) r
    WHERE temperature IS NOT NULL AND vibration IS NOT NULL AND pressure IS NOT NULL
)""", TRENDS_CTE.replace("ORDER BY event_timestamp, event_id", 'ORDER BY "timestamp", temperature, vibration, pressure')
      .replace("ORDER BY event_timestamp DESC, event_id DESC",
               'ORDER BY "timestamp" DESC, temperature DESC, vibration DESC, pressure DESC'),
f"""attached AS (
    SELECT o.machine_id, o."timestamp", o.temperature, o.vibration, o.pressure,
           {", ".join(f"s.{c}" for c in stats.STAT_COLUMNS)}, {", ".join(f"s.{c}" for c in stats.TREND_COLUMNS)}
    FROM ordered o LEFT JOIN (
        SELECT * FROM (SELECT machine_id, batch_date, count(*) AS batch_records, {BATCH_STATS_SQL}
                       FROM valid GROUP BY machine_id, batch_date) g
        JOIN trends t USING (machine_id, batch_date) WHERE batch_records > 1
    ) s ON s.machine_id = o.machine_id AND s.batch_date = o.batch_date AND o.rn_last = 1
)""")


@register("stream_batch_stats", with_ctes(
    "SELECT * FROM attached WHERE temp_mean IS NOT NULL", *_DEVICE_CTES))
def q_stream_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST4: statistics and trends on each machine's latest record of each micro-batch (records without an id)."""
    root = _run_transform(spark, _device_lines(spark, sf_dir))
    out = spark.read.parquet(root + "/delivered").filter(F.col("temp_mean").isNotNull())
    return out.select(*READING_FIELDS, *stats.STAT_COLUMNS, *stats.TREND_COLUMNS)


@register("republish_keyed", with_ctes("""
SELECT machine_id AS key, machine_id, "timestamp", temperature, vibration, pressure,
       temperature / nullif(vibration + 0.001, 0) AS temp_vib_ratio,
       pressure / nullif(temperature + 0.001, 0) AS pressure_temp_ratio, '1.0' AS data_version,
       temp_mean, vib_std, pressure_max, trend, temp_trend, false AS has_raw
FROM attached""", *_DEVICE_CTES))
def q_republish_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched records (ratios, metadata, batch statistics) published by key, their JSON read back."""
    root = _run_transform(spark, _device_lines(spark, sf_dir))
    fields = ("machine_id string, timestamp bigint, temperature double, vibration double, pressure double, "
              "temp_vib_ratio double, pressure_temp_ratio double, data_version string, temp_mean double, "
              "vib_std double, pressure_max double, trend string, temp_trend string")
    sent = spark.read.schema("key string, value string").json(root + "/keyed")
    return sent.select("key", F.from_json("value", fields).alias("v"),
                       F.array_contains(F.json_object_keys("value"), F.lit("raw")).alias("has_raw")).select(
        "key", "v.*", "has_raw")


@register("stream_edge_rule", with_ctes("""
SELECT event_id, machine_id, "timestamp", temperature, vibration, pressure,
       CASE WHEN temperature > 85 OR vibration > 2.0 OR pressure > 110 THEN 1 ELSE 0 END AS anomaly_score
FROM readings"""))
def q_stream_edge_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3 + S10 + S13: base64 transport records -> edge rule -> gzip JSON delivery by arrival hour."""
    root = _scratch(spark, "stream-edge")
    readings = load_readings(spark, sf_dir)
    records = rawsrc.stream_records(rawsrc.raw_json(readings))
    lines = records.select(F.to_json(F.struct("event_id", "data", "body")).alias("raw"),
                           _week().alias("week"))
    stream_sources.run_arrivals(lines, root, "week", lambda stream: stream_windows.start_edge_rule(
        stream, root + "/out", root + "/checkpoint"))
    schema = "event_id bigint, machine_id string, timestamp bigint, temperature double, " \
             "vibration double, pressure double, anomaly_score int"
    return spark.read.schema(schema).json(root + "/out").select(
        "event_id", "machine_id", "timestamp", "temperature", "vibration", "pressure", "anomaly_score")


@register("stream_ingest", with_ctes(f"SELECT event_id, {_READING_FIELDS_SQL} FROM readings"))
def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File-source stream, one weekly arrival per trigger, into a Parquet sink."""
    root = _scratch(spark, "stream-ingest")
    lines = _with_event_id(rawsrc.raw_json(load_readings(spark, sf_dir))).withColumn("week", _week())
    from pyspark.sql import types as T
    from machinewatch.schema import READING_SCHEMA
    schema = T.StructType([T.StructField("event_id", T.LongType()), *READING_SCHEMA.fields])
    stream_sources.run_arrivals(lines, root, "week", lambda stream: (
        stream.select(F.from_json("raw", schema).alias("r")).select("r.*").writeStream.format("parquet")
        .option("checkpointLocation", root + "/checkpoint").trigger(availableNow=True).start(root + "/out")))
    return spark.read.parquet(root + "/out")


# Batch twins of the windowed stream operators over the same validated records.
def _validated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = load_readings(spark, sf_dir)
    raw = _with_event_id(rawsrc.raw_bad(readings)).select(
        "raw", F.col("event_timestamp").alias("event_time"))
    return stream_transform.transform_records(raw)


def _rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup as a written table: the alarms read it several times, the records once."""
    path = _scratch(spark, "rollup")
    stream_windows.window_rollup(_validated_records(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


BUCKET_SQL = """CAST(TIMESTAMP '1970-01-01 00:00:00'
    + to_seconds(cast(floor(epoch(event_timestamp) / 300) * 300 AS bigint)) AS timestamp)"""
ROLLUP_SQL = f"""rollup AS (
    SELECT {BUCKET_SQL} AS window_start,
           {BUCKET_SQL} + INTERVAL 300 SECOND AS window_end,
           count(*) AS records, count(*) FILTER (WHERE NOT {ST1_VALID}) AS errors
    FROM readings GROUP BY 1, 2
)"""


@register("dashboard_rollup", with_ctes("SELECT * FROM rollup", ROLLUP_SQL))
def q_dashboard_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7: records and rejected records per 300 s window of event time."""
    return stream_windows.window_rollup(_validated_records(spark, sf_dir)).select(
        "window_start", "window_end", "records", "errors")


def _alarm_sql(value: str, breach: str, source: str) -> str:
    return f"""
SELECT w.window_start, w.{value}, {breach.format(v='w.' + value)} AS breach,
       {breach.format(v='w.' + value)} AND coalesce({breach.format(v='p.' + value)}, false) AS alarm
FROM {source} w LEFT JOIN {source} p ON p.window_start + INTERVAL 300 SECOND = w.window_start"""


@register("alarm_errors", with_ctes(_alarm_sql("errors", "{v} > 5", "rollup"), ROLLUP_SQL))
def q_alarm_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5: errors > 5 in two consecutive 300 s periods."""
    return stream_windows.alarm_errors(_rollup(spark, sf_dir))


@register("alarm_low_throughput", with_ctes(_alarm_sql("records", "{v} < 100", "filled"), ROLLUP_SQL, """
filled AS (
    SELECT s.window_start, cast(coalesce(r.records, 0) AS bigint) AS records
    FROM (SELECT unnest(generate_series(min(window_start), max(window_start), INTERVAL 300 SECOND))
                 AS window_start FROM rollup) s
    LEFT JOIN rollup r USING (window_start)
)"""))
def q_alarm_low_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6: input < 100 records in two consecutive 300 s periods (empty periods count as 0)."""
    return stream_windows.alarm_low_throughput(_rollup(spark, sf_dir))


# The same as streams: weekly arrivals, the query restarted from its checkpoint for each.
_WHOLE_LINE = '''concat('{"machine_id":"', machine_id, '","timestamp":', "timestamp",
        ',"vibration":', cast(k AS varchar), ',"pressure":', cast(k * 7 AS varchar),
        CASE WHEN k % 9 = 0 THEN '' ELSE concat(',"temperature":', cast(k * 3 AS varchar)) END, '}')'''
STREAM_ROLLUP_SQL = f"""lines AS (
    SELECT event_timestamp, k, {_WHOLE_LINE} AS raw
    FROM (SELECT *, event_id % 100 AS k FROM readings) r
),
rollup AS (
    SELECT {BUCKET_SQL} AS window_start, {BUCKET_SQL} + INTERVAL 300 SECOND AS window_end, count(*) AS records,
           cast(sum(length(raw)) AS bigint) AS bytes, count(*) FILTER (WHERE k % 9 = 0) AS errors
    FROM lines GROUP BY 1, 2
)"""


def whole_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly arrivals of records with whole numbers (every ninth of 100 without a temperature)."""
    k = F.col("event_id") % 100
    raw = F.concat(
        F.lit('{"machine_id":"'), F.col("machine_id"), F.lit('","timestamp":'), F.col("timestamp").cast("string"),
        F.lit(',"vibration":'), k.cast("string"), F.lit(',"pressure":'), (k * 7).cast("string"),
        F.when(k % 9 == 0, F.lit("")).otherwise(F.concat(F.lit(',"temperature":'), (k * 3).cast("string"))), F.lit("}"))
    return load_readings(spark, sf_dir).select(raw.alias("raw"), _week().alias("week"))


def _stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7's stream over ``whole_lines``."""
    root = _scratch(spark, "stream-rollup")

    def start(stream: DataFrame):
        records = stream_transform.transform_records(stream)
        return stream_windows.start_rollup(records.withColumn("event_time", F.timestamp_seconds("timestamp")), root)

    stream_sources.run_arrivals(whole_lines(spark, sf_dir), root, "week", start)
    return stream_windows.read_rollup(spark, root)


@register("stream_rollup", with_ctes("SELECT * FROM rollup", STREAM_ROLLUP_SQL))
def q_stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7 as a stream: records, bytes and rejected records per 300 s window."""
    return _stream_rollup(spark, sf_dir)


# The stream goes on: its newest window is open and not judged.
CLOSED_ROLLUP_SQL = "closed AS (SELECT * FROM rollup WHERE window_end <= (SELECT max(window_start) FROM rollup))"


@register("stream_alarm_errors", with_ctes(_alarm_sql("errors", "{v} > 5", "rollup"), STREAM_ROLLUP_SQL))
def q_stream_alarm_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5 over all windows that the rollup stream wrote, the newest included."""
    return stream_windows.alarm_errors(_stream_rollup(spark, sf_dir))


@register("stream_alarm_low_throughput", with_ctes(_alarm_sql("records", "{v} < 100", "filled"), STREAM_ROLLUP_SQL,
                                                   CLOSED_ROLLUP_SQL, """
filled AS (
    SELECT s.window_start, cast(coalesce(r.records, 0) AS bigint) AS records
    FROM (SELECT unnest(generate_series(min(window_start), max(window_start), INTERVAL 300 SECOND))
                 AS window_start FROM closed) s
    LEFT JOIN closed r USING (window_start)
)"""))
def q_stream_alarm_low_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6 over the closed windows that the rollup stream wrote."""
    return stream_windows.alarm_low_throughput(stream_windows.closed_windows(_stream_rollup(spark, sf_dir)))


_LATE_SQL = with_ctes(f"""
SELECT event_id, arrival_week,
       coalesce(event_timestamp < prior_max - INTERVAL 24 HOUR, false) AS is_late
FROM arr JOIN (
    SELECT arrival_week, max(batch_max) OVER (ORDER BY arrival_week
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_max
    FROM (SELECT arrival_week, max(event_timestamp) AS batch_max FROM arr GROUP BY arrival_week) b
) m USING (arrival_week)""", f"""arr AS (
    SELECT *, CASE WHEN event_id % {LATE_EVERY} = 0
                   THEN cast(date_trunc('week', event_timestamp) AS timestamp) + INTERVAL 7 DAY
                   ELSE cast(date_trunc('week', event_timestamp) AS timestamp) END AS arrival_week
    FROM readings
)""")


@register("late_split", _LATE_SQL)
def q_late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST8: rows older than the 24 h retention behind earlier batches are routed as late."""
    arrived = _arrival_week(load_readings(spark, sf_dir))
    out = stream_windows.late_split(arrived, batch_col="arrival_week", ts="event_timestamp",
                                    retention=_dt.timedelta(hours=24))
    return out.select("event_id", "arrival_week", "is_late")


@register("stream_late_split", _LATE_SQL)
def q_stream_late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST8 as a stream: late rows are routed aside, micro-batch by micro-batch."""
    root = _scratch(spark, "stream-late")
    arrived = _arrival_week(load_readings(spark, sf_dir))
    fields = F.struct("event_id", F.col("event_timestamp").cast("string").alias("event_time"),
                      F.col("arrival_week").cast("string").alias("arrival_week"))
    lines = arrived.select(F.to_json(fields).alias("raw"), F.col("arrival_week").alias("week"))

    def start(stream: DataFrame):
        records = stream.select(F.from_json(
            "raw", "event_id bigint, event_time timestamp_ntz, arrival_week timestamp_ntz").alias("r")).select("r.*")
        return (records.writeStream.foreachBatch(stream_windows.late_router(root))
                .option("checkpointLocation", root + "/checkpoint").trigger(availableNow=True).start())

    stream_sources.run_arrivals(lines, root, "week", start)
    late, on_time = (spark.read.schema("event_id bigint, arrival_week timestamp_ntz, is_late boolean").parquet(
        f"{root}/{sub}") for sub in ("late", "on_time"))
    return late.unionByName(on_time).select("event_id", "arrival_week", "is_late")


# ---------------------------------------------------------------------------
# Machine learning (M1-M12, S17, S21, S22, ST2)
# ---------------------------------------------------------------------------
from machinewatch.operators import ml  # noqa: E402
from machinewatch.operators.forest import load_forest  # noqa: E402
from machinewatch.sinks.files import write_csv  # noqa: E402


def training_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model input: validated readings (three sensors present), five features, label."""
    return enrich.feature_matrix(load_readings(spark, sf_dir).dropna(subset=list(SENSORS)))


def model_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``training_features`` with the events dealt over all cores before they are parsed: a small file is one task."""
    readings = events_to_readings(ml.spread(read_table(spark, sf_dir, "events")))
    return enrich.feature_matrix(readings.dropna(subset=list(SENSORS)))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: a query that trains, scores and compares computes its rows one time."""
    path = _scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


TRAIN_SQL = """feats AS (
    SELECT event_id, machine_id, temperature, vibration, pressure,
           temperature / nullif(vibration + 0.001, 0) AS temp_vib_ratio,
           pressure / nullif(temperature + 0.001, 0) AS pressure_temp_ratio,
           cast(label AS double) AS label
    FROM readings WHERE temperature IS NOT NULL AND vibration IS NOT NULL AND pressure IS NOT NULL
)"""


@register("stratified_split", with_ctes("""
SELECT event_id, label, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split
FROM (SELECT event_id, label,
             row_number() OVER (PARTITION BY label ORDER BY md5('42-' || cast(event_id AS varchar))) AS rn,
             count(*) OVER (PARTITION BY label) AS n
      FROM feats) t""", TRAIN_SQL))
def q_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: exact per-class 80/20 split by seeded hash order."""
    return ml.stratified_split(training_features(spark, sf_dir)).select("event_id", "label", "split")


@register("export_training_csv", with_ctes("""
SELECT temperature, vibration, pressure, temp_vib_ratio, pressure_temp_ratio, label AS anomaly_score
FROM feats""", TRAIN_SQL))
def q_export_training_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training matrix written as CSV with header and read back."""
    path = _scratch(spark, "training-csv")
    feats = training_features(spark, sf_dir)
    write_csv(feats.select(*ml.MODEL_FEATURES, F.col("label").alias("anomaly_score")), path)
    schema = ", ".join(f"{c} double" for c in (*ml.MODEL_FEATURES, "anomaly_score"))
    return spark.read.option("header", True).schema(schema).csv(path)


def _rule_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``predictions`` fixture: rule score as score, score >= 2 as prediction, label as truth."""
    return rule_predictions(spark, sf_dir).select(
        "event_id", "label", F.col("total_anomaly_score").alias("score"), "prediction")


PREDICTIONS_SQL = PRED_SQL + """,
scored AS (SELECT event_id, label, total_anomaly_score AS score, prediction FROM pred)"""


@register("eval_accuracy", sensor_sql("""
SELECT cast(count(*) FILTER (WHERE label = prediction) AS double) / count(*) AS accuracy
FROM scored""", PREDICTIONS_SQL))
def q_eval_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: accuracy of the rule predictions against the label."""
    return ml.accuracy(_rule_scored(spark, sf_dir))


@register("eval_auc", sensor_sql("""
SELECT sum(pos * (neg_below + neg / 2e0)) / (sum(pos) * cast(sum(neg) AS double)) AS roc_auc
FROM (SELECT score, pos, neg,
             coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 AS neg_below
      FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos,
                   count(*) FILTER (WHERE label = 0) AS neg
            FROM scored GROUP BY score) g) r""", PREDICTIONS_SQL))
def q_eval_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: exact ROC AUC (mid-ranks for ties) of the rule score."""
    return ml.roc_auc(_rule_scored(spark, sf_dir))


@register("confusion_matrix", sensor_sql("""
SELECT label, count(*) FILTER (WHERE prediction = 0) AS predicted_0,
       count(*) FILTER (WHERE prediction = 1) AS predicted_1
FROM scored GROUP BY label""", PREDICTIONS_SQL))
def q_confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: 2x2 confusion matrix of the rule predictions."""
    return ml.confusion_matrix(_rule_scored(spark, sf_dir))


_REPORT_CTES = """per AS (
    SELECT c AS class,
           CASE WHEN tp + fp > 0 THEN tp / cast(tp + fp AS double) ELSE 0e0 END AS precision,
           CASE WHEN tp + fn > 0 THEN tp / cast(tp + fn AS double) ELSE 0e0 END AS recall,
           tp + fn AS support
    FROM (SELECT '0' AS c, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tp,
                 count(*) FILTER (WHERE label <> 0 AND prediction = 0) AS fp,
                 count(*) FILTER (WHERE label = 0 AND prediction <> 0) AS fn FROM scored
          UNION ALL
          SELECT '1', count(*) FILTER (WHERE label = 1 AND prediction = 1),
                 count(*) FILTER (WHERE label <> 1 AND prediction = 1),
                 count(*) FILTER (WHERE label = 1 AND prediction <> 1) FROM scored) x
), f AS (
    SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                   ELSE 0e0 END AS f1 FROM per
)"""
_REPORT_BODY = """
SELECT class, precision, recall, f1, cast(support AS bigint) AS support FROM f
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), cast(sum(support) AS bigint) FROM f
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                 sum(f1 * support) / sum(support), cast(sum(support) AS bigint) FROM f"""


@register("classification_report", sensor_sql(_REPORT_BODY, PREDICTIONS_SQL, _REPORT_CTES))
def q_classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: precision, recall, f1, support per class, macro and weighted averages."""
    return ml.classification_report(_rule_scored(spark, sf_dir))


@register("postprocess_prediction", sensor_sql("""
SELECT event_id, prediction, CASE WHEN prediction = 1 THEN 'anomaly' ELSE 'normal' END AS prediction_label,
       CASE WHEN prediction = 1 THEN 'high' ELSE 'normal' END AS severity
FROM pred""", PRED_SQL))
def q_postprocess_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction label and severity."""
    return ml.postprocess_prediction(_rule_scored(spark, sf_dir)).select(
        "event_id", "prediction", "prediction_label", "severity")


SPLIT_SQL = """split AS (
    SELECT *, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split
    FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42-' || cast(event_id AS varchar))) AS rn,
                 count(*) OVER (PARTITION BY label) AS n FROM feats) t
)"""


def trained_model(spark: SparkSession, sf_dir: str, **params) -> tuple[str, dict]:
    """Train, save the model and its results, evaluate the saved model; (folder, results)."""
    out = _scratch(spark, "training")
    return out, ml.training_run(model_features(spark, sf_dir), out, **params)


@register("training_run", with_ctes("""
SELECT count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'test') AS test_rows,
       count(*) FILTER (WHERE split = 'test') AS confusion_total, true AS metrics_agree, true AS model_saved
FROM split""", TRAIN_SQL, SPLIT_SQL))
def q_training_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 + S22: end-to-end training; facts of the saved results record.

    ``metrics_agree``: accuracy equals the confusion matrix's, the AUC lies in
    [0.5, 1], the report's supports sum to the test rows. The metrics
    themselves depend on the forest and have no SQL.
    """
    out, _ = trained_model(spark, sf_dir)
    schema = ("model_path string, train_rows bigint, test_rows bigint, accuracy double, roc_auc double, "
              "classification_report map<string, struct<precision: double, recall: double, support: bigint>>, "
              "confusion_matrix array<array<bigint>>")
    res = spark.read.text(out + "/training_results").select(F.from_json("value", schema).alias("r")).select("r.*")
    cm = F.col("confusion_matrix")
    total = cm[0][0] + cm[0][1] + cm[1][0] + cm[1][1]
    agree = (F.abs(F.col("accuracy") - (cm[0][0] + cm[1][1]) / total) < 1e-9) & F.col("roc_auc").between(0.5, 1.0) & (
        F.col("classification_report")["macro avg"]["support"] == total)
    return res.select("train_rows", "test_rows", total.alias("confusion_total"), agree.alias("metrics_agree"),
                      (F.col("model_path") == F.lit(out + "/model")).alias("model_saved"))


@register("train_fixed", with_ctes("""
SELECT cast(cast(label AS int) AS varchar) AS class, count(*) AS support, true AS in_range, true AS learned
FROM split WHERE split = 'test' GROUP BY label
UNION ALL SELECT 'macro avg', count(*), true, true FROM split WHERE split = 'test'
UNION ALL SELECT 'weighted avg', count(*), true, true FROM split WHERE split = 'test'""", TRAIN_SQL, SPLIT_SQL))
def q_train_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + M5: the fixed forest (100 trees, depth 20); its report on the held-out split, which it must have learned."""
    parts = _stored(ml.stratified_split(model_features(spark, sf_dir)), "split")
    model = ml.train_fixed(parts.filter(F.col("split") == "train"))
    # The held-out rows are scored once; the report and the comparison read them.
    scored = _stored(ml.score(model, ml.spread(parts.filter(F.col("split") == "test"))).withColumn(
        "label", F.col("label").cast("int")), "scored")
    report = ml.classification_report(scored)
    in_range = F.lit(True)
    for measure in ("precision", "recall", "f1"):
        in_range = in_range & F.col(measure).between(0.0, 1.0)
    return report.select("class", "support", in_range.alias("in_range"), F.lit(_learned(scored)).alias("learned"))


def _learned(scored: DataFrame) -> bool:
    """Whether a model is better than the majority class and ranks better than the rule score does; ``scored`` is a stored table."""
    flags = sum((F.coalesce(c, F.lit(0)) for c in flag_columns().values()), F.lit(0))
    rows = scored.select("label", "prediction", "anomaly_probability", flags.alias("rule"))
    sizes = [r["count"] for r in rows.groupBy("label").count().collect()]
    auc = {c: ml.roc_auc(rows, score_col=c).first()["roc_auc"] for c in ("anomaly_probability", "rule")}
    right = ml.accuracy(rows).first()["accuracy"]
    return bool(right >= max(sizes) / sum(sizes) and auc["anomaly_probability"] > auc["rule"])


@register("model_roundtrip", with_ctes("""
SELECT event_id, machine_id, true AS same_prediction, true AS same_probability FROM feats""", TRAIN_SQL))
def q_model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model saved and loaded back scores every reading as the fitted one does."""
    feats = _stored(model_features(spark, sf_dir), "features")
    model = ml.train_fixed(feats)
    path = _scratch(spark, "model")
    ml.save_model(model, path)
    fitted = ml.score(model, ml.spread(feats)).select(
        "event_id", "machine_id", *ml.MODEL_FEATURES, F.col("prediction").alias("p"),
        F.col("anomaly_probability").alias("a")).drop("confidence")
    again = ml.score(ml.load_model(path), fitted)
    return again.select("event_id", "machine_id", (F.col("prediction") == F.col("p")).alias("same_prediction"),
                        (F.col("anomaly_probability") == F.col("a")).alias("same_probability"))


@register("flat_forest", with_ctes("""
SELECT event_id, true AS same_prediction, true AS same_probability, true AS same_confidence FROM feats""", TRAIN_SQL))
def q_flat_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved forest as flat arrays scores every reading as the saved pipeline does, to the last bit."""
    feats, path = _stored(model_features(spark, sf_dir), "features"), _scratch(spark, "flat-forest")
    ml.save_model(ml.train_fixed(feats), path)
    own = ml.score(ml.load_model(path), ml.spread(feats)).select(
        "event_id", "machine_id", *ml.MODEL_FEATURES, F.col("prediction").alias("p"), F.col("anomaly_probability").alias("a"),
        F.col("confidence").alias("c"))
    flat = ml.score(load_forest(spark, path), own)
    return flat.select("event_id", (F.col("prediction") == F.col("p")).alias("same_prediction"), (
        F.col("anomaly_probability") == F.col("a")).alias("same_probability"), (F.col("confidence") == F.col("c")).alias("same_confidence"))


@register("batch_score", with_ctes("""
SELECT event_id, true AS label_agrees, true AS severity_agrees, true AS confidence_agrees
FROM feats""", TRAIN_SQL))
def q_batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 + M11: every reading scored by the saved model; label, severity and confidence follow from the prediction."""
    out, _ = trained_model(spark, sf_dir)
    scored = ml.postprocess_prediction(ml.score(ml.load_model(out + "/model"), model_features(spark, sf_dir)))
    anomaly, p = F.col("prediction") == 1, F.col("anomaly_probability")
    return scored.select(
        "event_id", (F.col("prediction_label") == F.when(anomaly, "anomaly").otherwise("normal")).alias("label_agrees"),
        (F.col("severity") == F.when(anomaly, "high").otherwise("normal")).alias("severity_agrees"),
        (F.abs(F.col("confidence") - F.greatest(p, 1 - p)) < 1e-9).alias("confidence_agrees"))


@register("grid_search", with_ctes("""
SELECT t.v AS num_trees, d.v AS max_depth, m.v AS min_instances, true AS auc_above_chance, true AS refitted,
       (SELECT count(*) FROM split WHERE split = 'train') AS train_rows
FROM (VALUES (50), (100), (200)) t(v), (VALUES (10), (20), (30)) d(v), (VALUES (2), (5), (10)) m(v)""", TRAIN_SQL, SPLIT_SQL))
def q_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: the full grid (3 x 3 x 3) with five folds, scored by ROC AUC, on all training rows."""
    train = _stored(ml.stratified_split(model_features(spark, sf_dir)).filter(F.col("split") == "train"), "train")
    model, best, metrics = ml.grid_search(train)
    points = [(t, min(d or ml.SPARK_MAX_DEPTH, ml.SPARK_MAX_DEPTH), m) for t in ml.GRID_N_ESTIMATORS
              for d in ml.GRID_MAX_DEPTH for m in ml.GRID_MIN_SAMPLES_SPLIT]
    # Every point separates the classes, and the model that is used was fitted on all training rows.
    whole = len(model.stages[-1].trees) == best["numTrees"] and model.stages[-1].trees[0].depth <= best["maxDepth"]
    fitted = train.count()
    rows = [(*p, bool(0.5 < auc <= 1.0), bool(whole), fitted) for p, auc in zip(points, metrics, strict=True)]
    return spark.createDataFrame(
        rows, "num_trees int, max_depth int, min_instances int, auc_above_chance boolean, refitted boolean, train_rows bigint")


SCORE_VALID = """(event_id % 101 <> 0 AND temperature IS NOT NULL AND vibration IS NOT NULL AND pressure IS NOT NULL
    AND NOT (event_id % 107 = 0 AND event_id % 109 <> 0))"""


@register("stream_score", with_ctes(f"""
SELECT cast(row_number() OVER (ORDER BY week) - 1 AS bigint) AS batch_id, records, scored AS scored_records,
       scored AS metric_records, rejected AS rejected_records, rejected AS dead_letters, true AS alerts_agree
FROM (SELECT date_trunc('week', event_timestamp) AS week, count(*) AS records,
             count(*) FILTER (WHERE {SCORE_VALID}) AS scored, count(*) FILTER (WHERE NOT {SCORE_VALID}) AS rejected
      FROM readings GROUP BY 1) w"""))
def q_stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2: the saved model, as flat arrays, over a stream of partly defective records: each is scored or rejected, per micro-batch."""
    from machinewatch.streaming import scoring

    out, _ = trained_model(spark, sf_dir)
    model, root = load_forest(spark, out + "/model"), _scratch(spark, "stream-score")
    lines = rawsrc.raw_bad(events_to_readings(ml.spread(read_table(spark, sf_dir, "events")))).withColumn("week", _week())
    stream_sources.run_arrivals(lines, root, "week", lambda stream: scoring.start_scoring(stream, model, root))
    log = spark.read.schema("batch_id bigint, records bigint, scored_records bigint, rejected_records bigint").json(
        root + "/batch_log")
    metrics = spark.read.parquet(root + "/metrics").groupBy("batch_id").agg(
        F.count_if(F.col("metric_name") == "Temperature").alias("metric_records"),
        F.sum(F.when(F.col("metric_name") == "AnomalyPrediction", F.col("value"))).alias("anomalies"))
    dead = spark.read.schema("raw string, batch_id bigint").json(root + "/errors").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("dead_letters"))
    alerts = spark.read.parquet(root + "/alerts").groupBy("batch_id").agg(F.count(F.lit(1)).alias("alerts"))
    return log.join(metrics, "batch_id", "left").join(dead, "batch_id", "left").join(alerts, "batch_id", "left").select(
        "batch_id", "records", "scored_records", "metric_records", "rejected_records",
        F.coalesce("dead_letters", F.lit(0)).alias("dead_letters"),
        (F.coalesce("alerts", F.lit(0)) == F.coalesce("anomalies", F.lit(0.0))).alias("alerts_agree"))


VALIDATE_SCORING_EVERY = 10  # the defect of a record follows from its id modulo this


@register("validate_scoring", with_ctes(f"""
SELECT event_id, CASE WHEN k IN (1, 3, 4) THEN NULL ELSE "timestamp" END AS "timestamp",
       reject_reason IS NULL AS is_valid, reject_reason
FROM (SELECT *, CASE WHEN temperature IS NULL THEN 'missing_field:temperature'
                     WHEN vibration IS NULL THEN 'missing_field:vibration'
                     WHEN pressure IS NULL THEN 'missing_field:pressure'
                     WHEN k IN (3, 4) THEN 'invalid_type:timestamp' END AS reject_reason
      FROM (SELECT *, event_id % {VALIDATE_SCORING_EVERY} AS k FROM readings) a) b"""))
def q_validate_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 on the scoring path: absent time (1), time with a fraction (2), fraction in a text (3), null time (4),
    no machine (5); only the sensors are required."""
    from machinewatch.streaming.scoring import validate_records

    k = F.col("event_id") % VALIDATE_SCORING_EVERY
    time = F.col("timestamp").cast("string")
    field = (F.when(k == 1, F.lit(None)).when(k == 2, F.concat(F.lit('"timestamp":'), time, F.lit(".5")))
             .when(k == 3, F.concat(F.lit('"timestamp":"'), time, F.lit('.5"')))
             .when(k == 4, F.lit('"timestamp":null')).otherwise(F.concat(F.lit('"timestamp":'), time)))
    machine = F.when(k != 5, F.concat(F.lit('"machine_id":"'), F.col("machine_id"), F.lit('"')))
    sensors = F.regexp_replace(F.to_json(F.struct(*SENSORS)), r"^\{|\}$", "")
    body = F.concat_ws(",", machine, field, F.when(sensors != "", sensors))
    raw = load_readings(spark, sf_dir).select("event_id", F.concat(F.lit("{"), body, F.lit("}")).alias("raw"))
    return validate_records(raw).select("event_id", "timestamp", "is_valid", "reject_reason")
