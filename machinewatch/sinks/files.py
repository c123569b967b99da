"""File sinks: partitioned Parquet (S6, S7), overwrite Parquet (S8, S19), CSV (S17), JSON."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

PARTITION_KEYS = ("year", "month", "day", "hour")


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Temporarily change SQL settings for one action, then restore them."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = PARTITION_KEYS,
    sort_cols: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Hive-partitioned Parquet, idempotent under dynamic partition overwrite.

    ``REBALANCE`` on the partition keys sends each hour to one writer task
    and lets AQE split a hot hour over several tasks (skew split in
    rebalance), so no task writes into every partition folder and no task
    writes a whole hot hour. Coalescing is off for this write only: merging
    small partitions would leave a single task creating every folder.
    Sorting inside each task by (machine, time) keeps Parquet row-group
    min/max tight for later pushdown.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = df.hint("rebalance", n, *keys)
    if sort_cols:
        out = out.sortWithinPartitions(*keys, *sort_cols)
    with session_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        (out.write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys)
            .parquet(path))


def write_table(df: DataFrame, path: str, sort_cols: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Plain Parquet (summary tables, query results)."""
    out = df.sortWithinPartitions(*sort_cols) if sort_cols else df
    out.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row (training export)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """JSON lines (one object per line), optionally gzip."""
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.json(path)
