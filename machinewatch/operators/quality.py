"""Data quality: validation with reject reasons (P9), range warnings (P10),
dead-letter routing (S14).

All checks are column expressions over the raw text and its string-typed
fields, so one bad row never fails a task; it is routed with a reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from machinewatch.schema import PLAUSIBLE_RANGES, REQUIRED_FIELDS, SENSORS

TYPED = {"temperature": "double", "vibration": "double", "pressure": "double", "timestamp": "bigint"}


def _present(keys: Column, name: str) -> Column:
    return F.array_contains(keys, F.lit(name))


def typed_value(name: str, raw_col: str = "raw") -> Column:
    """A field in its type, NULL if it does not convert.

    A timestamp written as a JSON number may have a fraction, which is cut
    off; a text must be a whole number. A field that was filled in (absent in
    the raw record) is taken as it is.
    """
    value = F.col(name).try_cast(TYPED[name])
    if TYPED[name] != "bigint":
        return value
    number = F.from_json(F.col(raw_col), f"`{name}` double")[name]
    return F.coalesce(value, F.when(F.abs(number) < F.lit(2.0**62), number).cast("bigint"))


def reject_reason(raw_col: str = "raw", required: Sequence[str] = REQUIRED_FIELDS, keys: Column | None = None) -> Column:
    """First failing check, or NULL when the row is valid. ``keys`` are the record's, if they are at hand.

    Order: malformed JSON; missing key (in the order of ``required``); value
    not convertible (sensors to double, timestamp to bigint; a JSON null
    counts as not convertible); NaN or infinite sensor value.
    """
    keys = F.json_object_keys(F.col(raw_col)) if keys is None else keys
    expr = F.when(keys.isNull(), F.lit("malformed_json"))
    for name in required:
        expr = expr.when(~_present(keys, name), F.lit(f"missing_field:{name}"))
    for name in TYPED:
        # An optional key is checked only where the record has it.
        expr = expr.when(_present(keys, name) & typed_value(name, raw_col).isNull(), F.lit(f"invalid_type:{name}"))
    finite = None
    for s in SENSORS:
        v = F.col(s).try_cast("double")
        bad = F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
        finite = bad if finite is None else (finite | bad)
    return expr.when(finite, F.lit("not_finite"))


def validate_readings(parsed: DataFrame, raw_col: str = "raw",
                      required: Sequence[str] = REQUIRED_FIELDS, whole_col: str | None = None) -> DataFrame:
    """Typed reading columns plus ``is_valid`` and ``reject_reason``.

    ``parsed`` holds ``raw`` and the string-typed fields (``parse_raw``).
    Where its ``whole_col`` is true and no field is null, all keys are present
    and the text is not read for them.
    """
    # The keys are a column of their own: every check reads them, and the record is parsed for them once.
    reason = reject_reason(raw_col, required, F.col("_keys"))
    typed = {name: typed_value(name, raw_col) for name in TYPED}
    keys = F.json_object_keys(F.col(raw_col))
    if whole_col:
        complete = F.col(whole_col)
        for name in REQUIRED_FIELDS:
            complete = complete & F.col(name).isNotNull()
        keys = F.when(complete, F.array(*[F.lit(name) for name in REQUIRED_FIELDS])).otherwise(keys)
    return parsed.withColumn("_keys", keys).withColumn("reject_reason", reason).drop(
        "_keys").withColumns(typed).withColumn("is_valid", F.col("reject_reason").isNull())


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and rejected rows (two filters over one validated plan)."""
    return (validated.filter(F.col("is_valid")),
            validated.filter(~F.col("is_valid")))


def range_warnings(df: DataFrame, ranges: dict = PLAUSIBLE_RANGES) -> DataFrame:
    """P10: warn (never drop) when a sensor is outside its plausible inclusive range."""
    parts = []
    for s in SENSORS:
        low, high = ranges[s]
        v = F.col(s)
        parts.append(F.when(v.isNotNull() & ~v.between(low, high), F.lit(f"{s}_out_of_range")))
    warnings = F.concat_ws(",", *parts)
    count = sum((F.when(p.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for p in parts[1:]),
                F.when(parts[0].isNotNull(), F.lit(1)).otherwise(F.lit(0)))
    return df.withColumns({"warnings": warnings, "warning_count": count})


def dead_letter_rows(validated: DataFrame, raw_col: str = "raw") -> DataFrame:
    """The rejected rows in dead-letter form (raw text + reason + time of routing)."""
    keep = [c for c in ("event_id", "batch_id") if c in validated.columns]
    return validated.filter(~F.col("is_valid")).select(
        *keep, F.col(raw_col).alias("raw"), "reject_reason",
        F.current_timestamp().alias("routed_at"))
