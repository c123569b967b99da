"""Reading schemas and the fixed rule values of the monitored pipeline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SENSORS = ("temperature", "vibration", "pressure")

# Typed reading as produced by a device.
READING_SCHEMA = T.StructType(
    [
        T.StructField("machine_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("vibration", T.DoubleType()),
        T.StructField("pressure", T.DoubleType()),
    ]
)

# Raw landing schema: every field as text so a bad value is routed, not fatal.
RAW_STRING_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType()) for f in READING_SCHEMA.fields]
)

REQUIRED_FIELDS = ("machine_id", "temperature", "vibration", "pressure", "timestamp")
MODEL_FEATURES = ("temperature", "vibration", "pressure", "temp_vib_ratio", "pressure_temp_ratio")


@dataclass(frozen=True)
class Thresholds:
    """Upper limits per sensor; a reading strictly above a limit is flagged."""

    temperature: float
    vibration: float
    pressure: float


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference pipeline's for equal results.
# ---------------------------------------------------------------------------
# Batch ETL flags (each strictly greater than): temperature 80, vibration 2.0,
# pressure 150; total score = number of flags (0-3).
ETL_RULES = Thresholds(temperature=80.0, vibration=2.0, pressure=150.0)
# Edge rule: 1 when temperature > 85 or vibration > 2.0 or pressure > 110.
EDGE_RULES = Thresholds(temperature=85.0, vibration=2.0, pressure=110.0)
# Scoring-path plausible ranges (inclusive), outside gives a warning only:
# temperature 0-200, vibration 0-10, pressure 0-200.
PLAUSIBLE_RANGES = {
    "temperature": (0.0, 200.0),
    "vibration": (0.0, 10.0),
    "pressure": (0.0, 200.0),
}
# Outlier query ranges: temperature > 100 or < 20, vibration > 5 or < 0,
# pressure > 200 or < 50.
OUTLIER_RANGES = {
    "temperature": (20.0, 100.0),
    "vibration": (0.0, 5.0),
    "pressure": (50.0, 200.0),
}
# Efficiency rating of a machine's averages, all below (temperature, vibration, pressure); else POOR.
EFFICIENCY_LIMITS = {
    "EXCELLENT": (60.0, 1.5, 120.0),
    "GOOD": (70.0, 2.0, 140.0),
    "FAIR": (80.0, 2.5, 160.0),
}
# Energy category of a machine's averages, both below (temperature, vibration); else HIGH_ENERGY_USAGE.
ENERGY_LIMITS = {
    "ENERGY_EFFICIENT": (65.0, 1.5),
    "MODERATE_EFFICIENCY": (75.0, 2.0),
}
# Ratio features: temperature / (vibration + 0.001), pressure / (temperature + 0.001).
RATIO_EPSILON = 0.001
# Stream trend detection: last minus first beyond +-5 temperature,
# +-0.5 vibration, +-10 pressure; fewer than 3 readings -> insufficient_data.
TREND_DELTAS = {"temperature": 5.0, "vibration": 0.5, "pressure": 10.0}
TREND_MIN_READINGS = 3
TREND_NAMES = {"temperature": "temp_trend", "vibration": "vib_trend", "pressure": "pressure_trend"}
# Enrichment metadata.
DATA_VERSION = "1.0"
# Stream alarms: sum per 300 s window; errors > 5 and input < 100, each in two
# consecutive periods.
ALARM_PERIOD_SECONDS = 300
ALARM_ERROR_THRESHOLD = 5
ALARM_LOW_INPUT_THRESHOLD = 100
ALARM_EVALUATION_PERIODS = 2
# Event times outside these are taken for errors where periods are enumerated.
PLAUSIBLE_TIMES = ("2000-01-01 00:00:00", "2100-01-01 00:00:00")
# Stream retention: 24 hours.
RETENTION = "24 hours"
# Alerts and metrics.
ALERT_TYPE = "anomaly_detected"
ALERT_SEVERITY = "high"
ALERT_SUBJECT_PREFIX = "IoT Anomaly Alert - Machine "
UNKNOWN_MACHINE = "unknown"
METRIC_DIMENSION = "MachineId"
# Model training: 80/20 stratified split, seed 42, grid of 3 x 3 x 3, 5 folds.
TEST_FRACTION = 0.2
SEED = 42
GRID_N_ESTIMATORS = (50, 100, 200)
GRID_MAX_DEPTH = (10, 20, None)
GRID_MIN_SAMPLES_SPLIT = (2, 5, 10)
CV_FOLDS = 5
FIXED_N_ESTIMATORS = 100
FIXED_MAX_DEPTH = 20
