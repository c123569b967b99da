"""Every registered query with an oracle agrees with DuckDB on sf0.001 (fast subset)."""
import pytest

from check_oracle import compare
from conftest import SMALL

FAST = [
    "recent_readings", "machine_summary", "recent_anomalies", "anomaly_trends", "temp_by_hour",
    "hourly_averages", "daily_trends", "machine_comparison", "efficiency_ranking", "attention_needed",
    "maintenance_trend", "peak_hours", "weekly_summary", "completeness", "outliers",
    "energy_efficiency", "alert_status", "alert_frequency", "readme_recent_anomalies", "readme_trends",
    "lag_features", "machine_stats", "anomaly_summary", "machine_performance", "run_stats",
    "batch_stats", "detect_trends", "latest_reading", "attach_batch_stats", "validate_readings",
    "range_warnings", "decode_payload", "scan_concat_json", "alert_messages", "metrics_long",
    "dashboard_rollup", "alarm_errors", "alarm_low_throughput", "late_split", "stratified_split",
    "eval_auc", "classification_report", "confusion_matrix", "eval_accuracy",
    "event_time", "validate_scoring", "result_export", "stream_batch_stats", "model_roundtrip",
]


def test_registry_is_consistent():
    from __spark_entry__ import oracle_sql, queries

    qs, sql = queries(), oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 70


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, name):
    status, detail = compare(spark, SMALL, [name], verbose=False)[name]
    assert status == "OK", detail


def test_entry(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert "anomaly_rate" in df.columns
