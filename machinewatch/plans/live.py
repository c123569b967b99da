"""Registrations of the live operators: redelivery, distinct sketches, closed-period alarms, progress, bounded
delivery and record boundaries, with their DuckDB oracle text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from machinewatch.fixtures import load_readings, read_table, with_ctes
from machinewatch.functions.features import date_part_columns
from machinewatch.operators import distinct
from machinewatch.plans import registered as base
from machinewatch.plans.registry import register
from machinewatch.schema import SENSORS
from machinewatch.sources import crawl
from machinewatch.sources import raw as rawsrc
from machinewatch.sources import records as json_records
from machinewatch.streaming import alarms, delivery, progress, sources, transform, windows

_FIELDS = ("machine_id", "timestamp", *SENSORS)


# --- redelivery (survey 2.9) ---------------------------------------------------------------------

@register("stream_dedup", with_ctes("""
SELECT DISTINCT machine_id, cast(floor("timestamp" / 3600) * 3600 AS bigint) AS "timestamp", temperature, vibration, pressure
FROM readings WHERE temperature IS NOT NULL AND vibration IS NOT NULL AND pressure IS NOT NULL"""))
def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 53rd record arrives twice, the second time a week later and after a restart; each is delivered once."""
    readings = load_readings(spark, sf_dir).withColumn("timestamp", F.expr("timestamp div 3600 * 3600"))
    week = base._week()
    again = readings.filter(F.col("event_id") % base.REDELIVERED_EVERY == 0)
    lines = rawsrc.raw_json(readings).withColumn("week", week).unionByName(
        rawsrc.raw_json(again).withColumn("week", week + F.expr("INTERVAL 7 DAYS")))
    root = base._scratch(spark, "stream-dedup")
    paths = transform.TransformPaths(root)
    sources.run_arrivals(lines, root, "week", lambda stream: transform.start_transform(
        stream, paths, redelivered_within="24 hours"))
    return spark.read.parquet(paths.delivered).select(*_FIELDS)


# --- distinct counts that merge (A5) -------------------------------------------------------------

@register("distinct_devices", """
WITH days AS (SELECT cast(date_trunc('day', ts) AS date) AS period_start, user_id FROM events),
counted AS (
    SELECT 'day' AS period, period_start, count(*) AS records, count(DISTINCT user_id) AS distinct_exact FROM days GROUP BY 2
    UNION ALL
    SELECT 'week', cast(date_trunc('week', period_start) AS date), count(*), count(DISTINCT user_id) FROM days GROUP BY 2
    UNION ALL
    SELECT 'month', cast(date_trunc('month', period_start) AS date), count(*), count(DISTINCT user_id) FROM days GROUP BY 2
)
SELECT *, true AS within_bound FROM counted""")
def q_distinct_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5's option: hourly sketches of the devices, stored, and united per day, week and month beside the exact counts."""
    events = read_table(spark, sf_dir, "events").select("user_id", F.col("ts").alias("event_timestamp"))
    hourly = events.withColumns(date_part_columns())
    path = base._scratch(spark, "distinct")
    distinct.write_sketches(distinct.hourly_sketches(hourly, "user_id"), path)
    stored = distinct.read_sketches(spark, path).withColumn("day_start", F.make_date("year", "month", "day"))

    def start(period: str, day: Column) -> Column:
        return day if period == "day" else F.date_trunc(period, day).cast("date")

    out = None
    for period in ("day", "week", "month"):
        estimate = distinct.distinct_counts(stored.withColumn("period_start", start(period, F.col("day_start"))), ["period_start"])
        exact = distinct.exact_distinct(events.withColumn("period_start", start(period, F.to_date("event_timestamp"))),
                                        "user_id", ["period_start"])
        both = estimate.join(exact, "period_start").select(
            F.lit(period).alias("period"), "period_start", "records", "distinct_exact",
            F.col("distinct_exact").between(F.floor("distinct_low"), F.ceil("distinct_high")).alias("within_bound"))
        out = both if out is None else out.unionByName(both)
    return out


# --- alarms on closed periods (ST5, ST6) ---------------------------------------------------------

#: The fixture has about one record per period: low thresholds let both alarms come and go.
LIVE_ERRORS, LIVE_LOW = 0, 2
CLOSED_SQL = f"""bound AS (SELECT to_timestamp(floor(max("timestamp") / 300) * 300 - 600) AT TIME ZONE 'UTC' AS last_end FROM readings),
spine AS (
    SELECT window_start, window_start + INTERVAL 300 SECOND AS window_end
    FROM (SELECT unnest(generate_series(min(window_start), max(window_start), INTERVAL 300 SECOND)) AS window_start FROM rollup) s
),
closed AS (
    SELECT s.window_start, s.window_end, cast(coalesce(r.records, 0) AS bigint) AS records,
           cast(coalesce(r.errors, 0) AS bigint) AS errors
    FROM spine s LEFT JOIN rollup r USING (window_start) WHERE s.window_end <= (SELECT last_end FROM bound)
)"""
_LIVE_SQL = f"""
SELECT window_start, window_end, records, errors,
       errors > {LIVE_ERRORS} AND coalesce(lag(errors) OVER w > {LIVE_ERRORS}, false) AS errors_alarm,
       records < {LIVE_LOW} AND coalesce(lag(records) OVER w < {LIVE_LOW}, false) AS low_input_alarm
FROM closed WINDOW w AS (ORDER BY window_start)"""


def _whole_records(stream: DataFrame) -> DataFrame:
    return transform.transform_records(stream).withColumn("event_time", F.timestamp_seconds("timestamp"))


@register("live_alarms", with_ctes(_LIVE_SQL, base.STREAM_ROLLUP_SQL, CLOSED_SQL))
def q_live_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5 and ST6 live: each closed 300 s period, empty ones included, judged as the watermark closes it."""
    root = base._scratch(spark, "live-alarms")
    sources.run_arrivals(base.whole_lines(spark, sf_dir), root, "week", lambda stream: alarms.start_alarms(
        _whole_records(stream), root, error_threshold=LIVE_ERRORS, low_threshold=LIVE_LOW))
    judged = spark.read.parquet(root + "/periods")
    return judged.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")], "records", "errors",
                         "errors_alarm", "low_input_alarm")


@register("closed_alarms", with_ctes(_LIVE_SQL, base.STREAM_ROLLUP_SQL, CLOSED_SQL))
def q_closed_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5 and ST6 over the same records as one table: the periods closed by its newest record."""
    return alarms.closed_alarms(_whole_records(base.whole_lines(spark, sf_dir).select("raw")), error_threshold=LIVE_ERRORS,
                                low_threshold=LIVE_LOW)


# --- progress of each trigger (ST7, S23) ---------------------------------------------------------

@register("stream_dashboard", with_ctes("""
SELECT r.window_start, r.window_end, r.records, r.bytes, r.errors, b.batch_records, b.newest, true AS timed
FROM rollup r JOIN (
    SELECT date_trunc('week', event_timestamp) AS week, count(*) AS batch_records,
           max(to_timestamp("timestamp") AT TIME ZONE 'UTC') AS newest
    FROM readings GROUP BY 1
) b ON b.week = date_trunc('week', r.window_start)""", base.STREAM_ROLLUP_SQL))
def q_stream_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7 whole: windows with the records, duration and lag of the trigger that wrote them (times are wall-clock)."""
    root = base._scratch(spark, "stream-dashboard")
    table = progress.ProgressTable(spark, root + "/progress")
    runs = []

    def start(stream: DataFrame):
        runs.append(windows.start_rollup(_whole_records(stream), root, observe=table.name))
        return runs[-1]

    sources.run_arrivals(base.whole_lines(spark, sf_dir), root, "week", start)
    table.close(*runs)
    timed = (F.col("duration_ms") > 0) & (F.col("lag_ms") > 0)
    return progress.dashboard(spark, root).select(
        "window_start", "window_end", "records", "bytes", "errors", "batch_records",
        F.col("newest").cast("timestamp_ntz").alias("newest"), timed.alias("timed"))


# --- delivery in bounded files (S13) -------------------------------------------------------------

@register("stream_delivery", with_ctes("""
SELECT event_id, machine_id, "timestamp", temperature, vibration, pressure, cast(0 AS bigint) AS oversized FROM readings"""))
def q_stream_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly arrivals delivered in files of at most 5 MB, compacted twice, and read by the manifest."""
    root = base._scratch(spark, "stream-delivery")
    fields = "event_id bigint, machine_id string, timestamp bigint, temperature double, vibration double, pressure double"
    lines = base._with_event_id(rawsrc.raw_json(load_readings(spark, sf_dir))).withColumn("week", base._week())
    sources.run_arrivals(lines, root, "week", lambda stream: delivery.start_delivery(
        stream.select(F.from_json("raw", fields).alias("r")).select("r.*"), root))
    delivery.compact(spark, root)
    oversized = delivery.file_sizes(spark, root).filter(F.col("bytes") > delivery.MAX_BYTES).count()
    rows = delivery.read_delivered(spark, root).select(F.from_json("value", fields).alias("r")).select("r.*")
    return rows.withColumn("oversized", F.lit(oversized).cast("bigint"))


# --- record boundaries (S3) ----------------------------------------------------------------------

@register("scan_json_records", with_ctes("""
SELECT 'a}{"' || machine_id || '\\' AS machine_id, "timestamp", temperature, vibration, pressure FROM readings"""))
def q_scan_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: nested objects without separators or newlines, braces, quotes and backslashes inside strings."""
    path = base._scratch(spark, "json-records")
    readings = load_readings(spark, sf_dir).select(
        F.concat(F.lit('a}{"'), "machine_id", F.lit("\\")).alias("machine_id"), "timestamp", F.struct(*SENSORS).alias("sensors"))
    readings.select(F.to_json(F.struct("*")).alias("value")).write.option("lineSep", " ").text(path)
    nested = "machine_id string, timestamp bigint, sensors struct<temperature: double, vibration: double, pressure: double>"
    out = json_records.json_records(spark, path).select(F.from_json("raw", nested).alias("r"))
    return out.select("r.machine_id", "r.timestamp", "r.sensors.*")


# --- schema with drift (S18) ---------------------------------------------------------------------

#: Every such temperature is a text, and records carry a firmware from the second week of the table on.
TEXT_EVERY = 101


@register("schema_drift", with_ctes(f"""
SELECT column_name, data_type, types, records, first_seen, last_seen, changed_type,
       first_seen > min(first_seen) OVER () AS appeared_late, last_seen < max(last_seen) OVER () AS vanished
FROM (
    SELECT column_name, CASE WHEN count(DISTINCT kind) = 1 THEN min(kind) ELSE 'string' END AS data_type,
           string_agg(DISTINCT kind, ',' ORDER BY kind) AS types, count(*) AS records,
           cast(date_trunc('hour', min(event_timestamp)) AS timestamp) AS first_seen,
           cast(date_trunc('hour', max(event_timestamp)) AS timestamp) AS last_seen, count(DISTINCT kind) > 1 AS changed_type
    FROM (
        SELECT event_timestamp, unnest([
            {{'column_name': 'machine_id', 'kind': 'string'}}, {{'column_name': 'timestamp', 'kind': 'bigint'}},
            {{'column_name': 'temperature', 'kind': CASE WHEN event_id % {TEXT_EVERY} = 0 THEN 'string'
                                                      WHEN temperature IS NOT NULL THEN 'double' END}},
            {{'column_name': 'vibration', 'kind': CASE WHEN vibration IS NOT NULL THEN 'double' END}},
            {{'column_name': 'pressure', 'kind': CASE WHEN pressure IS NOT NULL THEN 'double' END}},
            {{'column_name': 'firmware', 'kind': CASE WHEN event_timestamp >= (SELECT min(ts) FROM events) + INTERVAL 7 DAY
                                                   THEN 'struct<major: bigint>' END}}], recursive := true)
        FROM readings) e
    WHERE kind IS NOT NULL GROUP BY column_name
) c"""))
def q_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake crawled in two steps (new folders only); columns that change type or appear late are reported."""
    readings = load_readings(spark, sf_dir)
    first = readings.agg(F.min("event_timestamp").alias("t")).first()["t"]
    number = F.when(F.col("event_id") % TEXT_EVERY != 0, F.col("temperature").cast("string"))
    fields = F.concat_ws(
        ",", F.concat(F.lit('"machine_id":"'), "machine_id", F.lit('","timestamp":'), F.col("timestamp").cast("string")),
        F.when(F.col("event_id") % TEXT_EVERY == 0, F.lit('"temperature":"bad"')).otherwise(
            F.concat(F.lit('"temperature":'), number)),
        *[F.concat(F.lit(f'"{s}":'), F.col(s).cast("string")) for s in ("vibration", "pressure")],
        F.when(F.col("event_timestamp") >= F.lit(first).cast("timestamp_ntz") + F.expr("INTERVAL 7 DAYS"), F.lit('"firmware":{"major":2}')))
    landed = readings.select(F.concat(F.lit("{"), fields, F.lit("}")).alias("value"), *[
        c.alias(n) for n, c in date_part_columns().items()])
    path, store = base._scratch(spark, "drift-lake"), base._scratch(spark, "drift-store")
    early = F.col("day") <= 10
    for part in (early, ~early):
        landed.filter(part).hint("rebalance", *base.rawsrc.LAKE_KEYS).write.mode("append").partitionBy(
            *base.rawsrc.LAKE_KEYS).text(path)
        crawl.crawl(spark, path, store)
    return crawl.lake_schema(spark, store)
