"""Hand-written boundary rows (the ``edges`` fixture)."""
import datetime as dt

from pyspark.sql import functions as F

from machinewatch.functions.features import score_level
from machinewatch.operators import enrich, quality, stats
from machinewatch.sources import raw as rawsrc


def _readings(spark, rows):
    return spark.createDataFrame(
        rows, "event_id long, machine_id string, event_timestamp timestamp_ntz, "
              "temperature double, vibration double, pressure double")


T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def test_threshold_boundaries_and_nulls(spark):
    df = _readings(spark, [
        (1, "M1", T0, 80.0, 2.0, 150.0),        # exactly at the limits: no flag
        (2, "M1", T0, 80.01, 2.01, 150.01),     # just above: all flags
        (3, "M1", T0, None, None, None),        # NULL -> 0
    ])
    out = {r.event_id: r for r in enrich.derive_features(df, processing_time=False).collect()}
    assert out[1].total_anomaly_score == 0
    assert out[2].total_anomaly_score == 3
    assert out[3].total_anomaly_score == 0


def test_zero_denominator_gives_null(spark):
    df = _readings(spark, [(1, "M1", T0, -0.001, -0.001, 5.0)])
    r = enrich.derive_features(df, processing_time=False).first()
    assert r.temp_vib_ratio is None and r.pressure_temp_ratio is None


def test_severity_levels(spark):
    df = spark.createDataFrame([(s,) for s in range(4)], "total_anomaly_score int")
    got = [r[0] for r in df.select(score_level()).orderBy(F.col("total_anomaly_score")).collect()]
    assert got == ["NORMAL", "MEDIUM", "HIGH", "CRITICAL"]


def test_batch_stats_single_row_std_zero(spark):
    df = _readings(spark, [(1, "M1", T0, 60.0, 1.0, 100.0)])
    r = stats.batch_stats(df).first()
    assert r.temp_std == 0.0 and r.batch_records == 1


def test_trend_insufficient_and_directions(spark):
    rows = [(1, "A", T0, 60.0, 1.0, 100.0), (2, "A", T0 + dt.timedelta(seconds=1), 61.0, 1.0, 100.0),
            (3, "B", T0, 60.0, 1.0, 100.0), (4, "B", T0 + dt.timedelta(seconds=1), 70.0, 0.2, 100.0),
            (5, "B", T0 + dt.timedelta(seconds=2), 65.01, 0.49, 110.0)]
    out = {r.machine_id: r for r in stats.detect_trends(_readings(spark, rows)).collect()}
    assert out["A"].trend == "insufficient_data" and out["A"].temp_trend is None
    assert out["B"].trend is None
    assert out["B"].temp_trend == "increasing"      # 65.01 > 60 + 5
    assert out["B"].vib_trend == "decreasing"       # 0.49 < 1.0 - 0.5
    assert out["B"].pressure_trend == "stable"      # 110 is not > 100 + 10


def test_attach_stats_only_latest_row(spark):
    rows = [(1, "A", T0, 60.0, 1.0, 100.0), (2, "A", T0 + dt.timedelta(seconds=1), 62.0, 1.0, 100.0),
            (3, "C", T0, 60.0, 1.0, 100.0)]
    out = {r.event_id: r for r in stats.attach_batch_stats(_readings(spark, rows)).collect()}
    assert out[1].temp_mean is None and out[2].temp_mean == 61.0
    assert out[3].temp_mean is None  # a group of one row gets no statistics


def test_validation_reasons(spark):
    texts = [
        (1, '{"machine_id":"M","timestamp":1,"temperature":1,"vibration":1,"pressure":1}'),
        (2, '{"timestamp":1,"temperature":1,"vibration":1,"pressure":1}'),
        (3, '{"machine_id":"M","timestamp":null,"temperature":1,"vibration":1,"pressure":1}'),
        (4, '{"machine_id":"M","temperature":1,"vibration":1,"pressure":1}'),
        (5, '{"machine_id":"M","timestamp":1,"temperature":"bad","vibration":1,"pressure":1}'),
        (6, '{"machine_id":"M","timestamp":1,"temperature":"NaN","vibration":1,"pressure":1}'),
        (7, 'not json'),
        (8, '{"machine_id":"M","timestamp":"5","temperature":"61.5","vibration":1,"pressure":1}'),
    ]
    df = spark.createDataFrame(texts, "event_id long, raw string")
    out = {r.event_id: r.reject_reason for r in
           quality.validate_readings(rawsrc.parse_raw(df)).collect()}
    assert out == {1: None, 2: "missing_field:machine_id", 3: "invalid_type:timestamp",
                   4: "missing_field:timestamp", 5: "invalid_type:temperature", 6: "not_finite",
                   7: "malformed_json", 8: None}


def test_valid_plus_rejected_is_input(spark):
    from conftest import SMALL
    from machinewatch.fixtures import load_readings

    v = quality.validate_readings(rawsrc.parse_raw(rawsrc.raw_bad(load_readings(spark, SMALL))))
    good, bad = quality.split_valid(v)
    assert good.count() + bad.count() == v.count()


def test_bad_base64_falls_back_to_null(spark):
    df = spark.createDataFrame([("!!", None), (None, '{"a":1}')], "data string, body string")
    got = [r.raw for r in rawsrc.decode_payload(df).collect()]
    assert got == [None, '{"a":1}']


def test_concatenated_json_split(spark):
    df = spark.createDataFrame([('{"a":1}{"a":2} {"a":3}',)], "v string")
    parts = df.select(F.explode(rawsrc.split_concatenated(F.col("v")))).collect()
    assert [p[0].strip() for p in parts] == ['{"a":1}', '{"a":2}', '{"a":3}']
