"""Rows in one global order, dealt over range partitions of about equal size.

A window without a partition key, or one whose key holds a third of all rows,
is a single task. Here the rows are dealt by sampled ranges of the order
itself, each row remembers its range, and what has to cross a border is one
row per range (and key): a table whose size is the number of ranges. Rows that
are equal in all order columns stay in one range; give the order a tie-breaker
where that may be many.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_ranges(df: DataFrame, order: Sequence[Column], path: str, part: str = "part",
              parts: int | None = None) -> DataFrame:
    """``df`` written to ``path`` in ranges of ``order``, with the range's number (ascending) as ``part``.

    Ranges come from a sample, so a plan that is evaluated twice could cut
    them differently: the rows are written once and read from then on.
    ``parts`` defaults to the session's shuffle partitions.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(parts, *order).withColumn(part, F.spark_partition_id()).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def running_offsets(ranged: DataFrame, value: Column, keys: Sequence[str] = (), part: str = "part",
                    name: str = "offset") -> DataFrame:
    """Per key and range: the sum of ``value`` over that key's earlier ranges, as ``name``.

    One row per key and range is summed map-side first; the running sum of a
    key then goes over at most as many rows as there are ranges.
    """
    sums = ranged.groupBy(*keys, part).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys or [F.lit(0)]).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn(name, F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
