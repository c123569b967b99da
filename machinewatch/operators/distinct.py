"""Distinct counts that merge: a sketch per hour, united for any window of hours.

A distinct count cannot be added up over hours; its sketch can be united. The
table of sketches has one row per key and hour (a few kB each), so a window of
any length reads those rows alone, never the readings. A late hour is written
again and replaces its own row.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from machinewatch.sinks.files import write_partitioned

#: 2^12 buckets: a standard error of about 1.6 %.
LOG_BUCKETS = 12
HOUR = ("year", "month", "day", "hour")


def standard_error(log_buckets: int = LOG_BUCKETS) -> float:
    """Relative standard error of a united sketch's estimate."""
    return 1.04 / math.sqrt(1 << log_buckets)


def hourly_sketches(rows: DataFrame, value: str, keys: Sequence[str] = (), log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """``keys, year, month, day, hour, records, sketch``: null values are counted as records only.

    Sketches are built map-side, so a hot key or hour sends one per task.
    """
    return rows.groupBy(*keys, *HOUR).agg(
        F.count(F.lit(1)).alias("records"),
        F.hll_sketch_agg(F.col(value).cast("string"), F.lit(log_buckets)).alias("sketch"))


def write_sketches(sketches: DataFrame, path: str) -> None:
    """Hour by hour: an hour that is written again replaces its earlier sketch, the others stay."""
    write_partitioned(sketches, path, HOUR)


def read_sketches(spark: SparkSession, path: str, since: dt.datetime | None = None,
                  until: dt.datetime | None = None) -> DataFrame:
    """Stored sketches of the hours in ``[since, until)``; only the folders of those days and hours are listed."""
    stored = spark.read.parquet(path)
    day = F.make_date(F.col("year"), F.col("month"), F.col("day"))
    start = F.make_timestamp_ntz(F.col("year"), F.col("month"), F.col("day"), F.col("hour"), F.lit(0), F.lit(0))
    if since is not None:
        stored = stored.filter((day >= F.lit(since.date())) & (start >= F.lit(since).cast("timestamp_ntz")))
    if until is not None:
        stored = stored.filter((day <= F.lit(until.date())) & (start < F.lit(until).cast("timestamp_ntz")))
    return stored


def distinct_counts(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by, records, distinct_estimate, distinct_low, distinct_high``: united over all hours of a group.

    ``low`` and ``high`` are three standard errors away.
    """
    united = sketches.groupBy(*by).agg(F.sum("records").alias("records"), F.hll_union_agg("sketch", F.lit(True)).alias("sketch"))
    spread = 3 * standard_error()
    estimate = F.hll_sketch_estimate("sketch")
    return united.select(
        *by, "records", estimate.alias("distinct_estimate"), (estimate * (1 - spread)).alias("distinct_low"),
        (estimate * (1 + spread)).alias("distinct_high")).filter(F.col("records") > 0)


def exact_distinct(rows: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """The exact count beside the estimate: ``by, distinct_exact``; one shuffle of the distinct values."""
    return rows.groupBy(*by).agg(F.countDistinct(F.col(value).cast("string")).alias("distinct_exact"))
