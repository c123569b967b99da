"""DuckDB oracle text for the query catalogue (``NOW()`` bound to the latest event)."""

from __future__ import annotations

from machinewatch.fixtures import AS_OF_SQL, sensor_sql

NOW = AS_OF_SQL
DATE = "cast(event_timestamp AS date)"
HOUR = "cast(hour(event_timestamp) AS int)"
ANOM = "cast(sum(CASE WHEN total_anomaly_score > 0 THEN 1 ELSE 0 END) AS bigint)"


def _since(interval: str) -> str:
    return f"event_timestamp >= {NOW} - INTERVAL {interval}"


def _pct(num: str, den: str) -> str:
    return f"cast({num} AS double) * 100e0 / cast({den} AS double)"


BODIES = {
    "recent_readings": f"""
SELECT machine_id, temperature, vibration, pressure, event_timestamp, total_anomaly_score
FROM sensor_data WHERE {_since('24 HOUR')}
ORDER BY event_timestamp DESC, event_id DESC LIMIT 100""",
    "machine_summary": f"""
SELECT machine_id, count(*) AS total_readings, avg(temperature) AS avg_temperature,
       avg(vibration) AS avg_vibration, avg(pressure) AS avg_pressure,
       max(temperature) AS max_temperature, min(temperature) AS min_temperature,
       stddev_samp(temperature) AS temp_std_dev
FROM sensor_data WHERE {_since('7 DAY')}
GROUP BY machine_id ORDER BY avg_temperature DESC""",
    "recent_anomalies": f"""
SELECT machine_id, temperature, vibration, pressure, total_anomaly_score, event_timestamp,
       CASE WHEN total_anomaly_score >= 3 THEN 'CRITICAL'
            WHEN total_anomaly_score >= 2 THEN 'HIGH'
            WHEN total_anomaly_score >= 1 THEN 'MEDIUM'
            ELSE 'NORMAL' END AS severity_level
FROM sensor_data WHERE total_anomaly_score > 0 AND {_since('24 HOUR')}
ORDER BY event_timestamp DESC""",
    "anomaly_trends": f"""
SELECT machine_id, {DATE} AS date, count(*) AS total_readings, {ANOM} AS anomaly_count,
       {_pct(ANOM, 'count(*)')} AS anomaly_percentage
FROM sensor_data WHERE {_since('30 DAY')}
GROUP BY machine_id, {DATE} ORDER BY machine_id, date""",
    "temp_by_hour": f"""
SELECT machine_id, {HOUR} AS hour_of_day, count(*) AS total_readings,
       cast(sum(CASE WHEN temperature > 80 THEN 1 ELSE 0 END) AS bigint) AS high_temp_count,
       avg(temperature) AS avg_temperature, max(temperature) AS max_temperature
FROM sensor_data WHERE {_since('7 DAY')}
GROUP BY machine_id, {HOUR} ORDER BY machine_id, hour_of_day""",
    "hourly_averages": f"""
SELECT machine_id, {DATE} AS date, {HOUR} AS hour, avg(temperature) AS avg_temperature,
       avg(vibration) AS avg_vibration, avg(pressure) AS avg_pressure,
       count(*) AS reading_count
FROM sensor_data WHERE {_since('7 DAY')}
GROUP BY machine_id, {DATE}, {HOUR} ORDER BY machine_id, date, hour""",
    "daily_trends": f"""
SELECT machine_id, {DATE} AS date, avg(temperature) AS avg_temperature,
       avg(vibration) AS avg_vibration, avg(pressure) AS avg_pressure,
       stddev_samp(temperature) AS temp_volatility, count(*) AS daily_readings
FROM sensor_data WHERE {_since('30 DAY')}
GROUP BY machine_id, {DATE} ORDER BY machine_id, date""",
    "machine_comparison": f"""
, machine_stats AS (
    SELECT machine_id, avg(temperature) AS avg_temp, avg(vibration) AS avg_vib,
           avg(pressure) AS avg_pressure, stddev_samp(temperature) AS temp_std,
           count(*) AS total_readings, {ANOM} AS anomaly_count
    FROM sensor_data WHERE {_since('7 DAY')}
    GROUP BY machine_id)
SELECT machine_id, avg_temp, avg_vib, avg_pressure, temp_std, total_readings, anomaly_count,
       {_pct('anomaly_count', 'total_readings')} AS anomaly_rate
FROM machine_stats ORDER BY anomaly_rate DESC""",
    "efficiency_ranking": f"""
SELECT machine_id, avg(temperature) AS avg_temperature, avg(vibration) AS avg_vibration,
       avg(pressure) AS avg_pressure, count(*) AS total_readings, {ANOM} AS anomaly_count,
       CASE WHEN avg(temperature) < 60 AND avg(vibration) < 1.5 AND avg(pressure) < 120 THEN 'EXCELLENT'
            WHEN avg(temperature) < 70 AND avg(vibration) < 2.0 AND avg(pressure) < 140 THEN 'GOOD'
            WHEN avg(temperature) < 80 AND avg(vibration) < 2.5 AND avg(pressure) < 160 THEN 'FAIR'
            ELSE 'POOR' END AS efficiency_rating
FROM sensor_data WHERE {_since('7 DAY')}
GROUP BY machine_id ORDER BY efficiency_rating, avg_temperature""",
    "attention_needed": f"""
SELECT machine_id, count(*) AS total_readings,
       cast(sum(CASE WHEN total_anomaly_score >= 2 THEN 1 ELSE 0 END) AS bigint) AS critical_anomalies,
       avg(temperature) AS avg_temperature, avg(vibration) AS avg_vibration,
       avg(pressure) AS avg_pressure, max(temperature) AS max_temperature,
       max(vibration) AS max_vibration, max(pressure) AS max_pressure
FROM sensor_data WHERE {_since('24 HOUR')}
GROUP BY machine_id
HAVING sum(CASE WHEN total_anomaly_score >= 2 THEN 1 ELSE 0 END) > 0
ORDER BY critical_anomalies DESC""",
    "maintenance_trend": f"""
SELECT machine_id, {DATE} AS date, avg(temperature) AS avg_temp, avg(vibration) AS avg_vib,
       avg(pressure) AS avg_pressure,
       lag(avg(temperature), 1) OVER (PARTITION BY machine_id ORDER BY {DATE}) AS prev_avg_temp,
       lag(avg(vibration), 1) OVER (PARTITION BY machine_id ORDER BY {DATE}) AS prev_avg_vib,
       lag(avg(pressure), 1) OVER (PARTITION BY machine_id ORDER BY {DATE}) AS prev_avg_pressure,
       avg(temperature) - lag(avg(temperature), 1) OVER (PARTITION BY machine_id ORDER BY {DATE}) AS temp_trend,
       avg(vibration) - lag(avg(vibration), 1) OVER (PARTITION BY machine_id ORDER BY {DATE}) AS vib_trend,
       avg(pressure) - lag(avg(pressure), 1) OVER (PARTITION BY machine_id ORDER BY {DATE}) AS pressure_trend
FROM sensor_data WHERE {_since('14 DAY')}
GROUP BY machine_id, {DATE} ORDER BY machine_id, date""",
    "peak_hours": f"""
SELECT {HOUR} AS hour_of_day, count(*) AS total_readings, avg(temperature) AS avg_temperature,
       avg(vibration) AS avg_vibration, avg(pressure) AS avg_pressure, {ANOM} AS anomaly_count
FROM sensor_data WHERE {_since('7 DAY')}
GROUP BY {HOUR} ORDER BY total_readings DESC""",
    "weekly_summary": f"""
SELECT machine_id, cast(date_trunc('week', event_timestamp) AS timestamp) AS week_start,
       count(*) AS weekly_readings, avg(temperature) AS weekly_avg_temp,
       avg(vibration) AS weekly_avg_vib, avg(pressure) AS weekly_avg_pressure,
       {ANOM} AS weekly_anomalies, {_pct(ANOM, 'count(*)')} AS weekly_anomaly_rate
FROM sensor_data WHERE {_since('56 DAY')}
GROUP BY machine_id, date_trunc('week', event_timestamp) ORDER BY machine_id, week_start""",
    "completeness": f"""
SELECT machine_id, count(*) AS total_records, count(temperature) AS temp_records,
       count(vibration) AS vib_records, count(pressure) AS pressure_records,
       {_pct('count(temperature)', 'count(*)')} AS temp_completeness,
       {_pct('count(vibration)', 'count(*)')} AS vib_completeness,
       {_pct('count(pressure)', 'count(*)')} AS pressure_completeness
FROM sensor_data WHERE {_since('7 DAY')}
GROUP BY machine_id ORDER BY machine_id""",
    "outliers": f"""
SELECT machine_id, temperature, vibration, pressure, event_timestamp,
       CASE WHEN temperature > 100 OR temperature < 20 THEN 'TEMPERATURE_OUTLIER'
            WHEN vibration > 5 OR vibration < 0 THEN 'VIBRATION_OUTLIER'
            WHEN pressure > 200 OR pressure < 50 THEN 'PRESSURE_OUTLIER'
            ELSE 'NORMAL' END AS outlier_type
FROM sensor_data WHERE {_since('24 HOUR')}
  AND (temperature > 100 OR temperature < 20 OR vibration > 5 OR vibration < 0
       OR pressure > 200 OR pressure < 50)
ORDER BY event_timestamp DESC""",
    "energy_efficiency": f"""
SELECT machine_id, avg(temperature) AS avg_temperature, avg(vibration) AS avg_vibration,
       avg(pressure) AS avg_pressure, count(*) AS total_readings, {ANOM} AS anomaly_count,
       CASE WHEN avg(temperature) < 65 AND avg(vibration) < 1.5 THEN 'ENERGY_EFFICIENT'
            WHEN avg(temperature) < 75 AND avg(vibration) < 2.0 THEN 'MODERATE_EFFICIENCY'
            ELSE 'HIGH_ENERGY_USAGE' END AS efficiency_category
FROM sensor_data WHERE {_since('7 DAY')}
GROUP BY machine_id ORDER BY efficiency_category, avg_temperature""",
    "alert_status": f"""
SELECT machine_id, temperature, vibration, pressure, total_anomaly_score, event_timestamp,
       CASE WHEN total_anomaly_score >= 3 THEN 'CRITICAL_ALERT'
            WHEN total_anomaly_score >= 2 THEN 'HIGH_ALERT'
            WHEN total_anomaly_score >= 1 THEN 'MEDIUM_ALERT'
            ELSE 'NORMAL' END AS alert_level
FROM sensor_data WHERE {_since('1 HOUR')} AND total_anomaly_score > 0
ORDER BY total_anomaly_score DESC, event_timestamp DESC""",
    "alert_frequency": f"""
SELECT machine_id, count(*) AS total_alerts,
       count(CASE WHEN total_anomaly_score >= 3 THEN 1 END) AS critical_alerts,
       count(CASE WHEN total_anomaly_score = 2 THEN 1 END) AS high_alerts,
       count(CASE WHEN total_anomaly_score = 1 THEN 1 END) AS medium_alerts,
       max(event_timestamp) AS last_alert_time
FROM sensor_data WHERE {_since('7 DAY')} AND total_anomaly_score > 0
GROUP BY machine_id ORDER BY total_alerts DESC""",
    "readme_recent_anomalies": """
SELECT *, total_anomaly_score > 0 AS anomaly_detected
FROM sensor_data WHERE total_anomaly_score > 0
ORDER BY event_timestamp DESC, event_id DESC LIMIT 100""",
    "readme_trends": f"""
SELECT machine_id, avg(temperature) AS avg_temp, avg(vibration) AS avg_vibration
FROM sensor_data WHERE {_since('24 HOUR')}
GROUP BY machine_id""",
}


def catalogue_sql() -> dict[str, str]:
    out = {}
    for name, body in BODIES.items():
        body = body.strip("\n")
        if body.startswith(","):
            # Query with its own CTE: append it after sensor_data.
            cte, _, rest = body[1:].partition("\nSELECT")
            out[name] = sensor_sql("SELECT" + rest, cte.strip())
        else:
            out[name] = sensor_sql(body)
    return out
