"""Column expressions shared by batch, SQL and streaming paths.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from machinewatch.schema import ETL_RULES, EDGE_RULES, OUTLIER_RANGES, RATIO_EPSILON, Thresholds


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """``numerator / (denominator + 0.001)``; a zero denominator gives NULL (ANSI-safe)."""
    return F.try_divide(col_(numerator), col_(denominator) + F.lit(RATIO_EPSILON))


def ratio_columns(t: str = "temperature", v: str = "vibration", p: str = "pressure") -> dict[str, Column]:
    return {
        "temp_vib_ratio": safe_ratio(t, v),
        "pressure_temp_ratio": safe_ratio(p, t),
    }


def flag(c: str | Column, limit: float) -> Column:
    """1 when strictly above ``limit``; NULL readings give 0."""
    return F.when(col_(c) > F.lit(limit), F.lit(1)).otherwise(F.lit(0))


def flag_columns(rules: Thresholds = ETL_RULES) -> dict[str, Column]:
    return {
        "is_anomaly_temp": flag("temperature", rules.temperature),
        "is_anomaly_vib": flag("vibration", rules.vibration),
        "is_anomaly_pressure": flag("pressure", rules.pressure),
    }


def score_column() -> Column:
    return F.col("is_anomaly_temp") + F.col("is_anomaly_vib") + F.col("is_anomaly_pressure")


def date_part_columns(ts: str = "event_timestamp") -> dict[str, Column]:
    c = F.col(ts)
    return {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "hour": F.hour(c),
    }


def edge_rule(rules: Thresholds = EDGE_RULES) -> Column:
    """Any-of rule: 1 if temperature, vibration or pressure is above its limit."""
    hit = (
        (F.col("temperature") > F.lit(rules.temperature))
        | (F.col("vibration") > F.lit(rules.vibration))
        | (F.col("pressure") > F.lit(rules.pressure))
    )
    return F.when(hit, F.lit(1)).otherwise(F.lit(0))


def score_level(score: str | Column = "total_anomaly_score", suffix: str = "") -> Column:
    """Severity CASE: CRITICAL >= 3, HIGH >= 2, MEDIUM >= 1, else NORMAL."""
    s = col_(score)
    return (
        F.when(s >= 3, F.lit("CRITICAL" + suffix))
        .when(s >= 2, F.lit("HIGH" + suffix))
        .when(s >= 1, F.lit("MEDIUM" + suffix))
        .otherwise(F.lit("NORMAL"))
    )


def _outside(c: str, bounds: tuple[float, float]) -> Column:
    low, high = bounds
    return (F.col(c) > F.lit(high)) | (F.col(c) < F.lit(low))


def outlier_predicate(ranges: dict = OUTLIER_RANGES) -> Column:
    return (
        _outside("temperature", ranges["temperature"])
        | _outside("vibration", ranges["vibration"])
        | _outside("pressure", ranges["pressure"])
    )


def outlier_type(ranges: dict = OUTLIER_RANGES) -> Column:
    """First matching range wins: temperature, then vibration, then pressure."""
    return (
        F.when(_outside("temperature", ranges["temperature"]), F.lit("TEMPERATURE_OUTLIER"))
        .when(_outside("vibration", ranges["vibration"]), F.lit("VIBRATION_OUTLIER"))
        .when(_outside("pressure", ranges["pressure"]), F.lit("PRESSURE_OUTLIER"))
        .otherwise(F.lit("NORMAL"))
    )


def count_when(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as a bigint."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def percent(numerator: Column, denominator: Column) -> Column:
    """``numerator * 100.0 / denominator`` in double arithmetic."""
    return numerator.cast("double") * F.lit(100.0) / denominator.cast("double")
