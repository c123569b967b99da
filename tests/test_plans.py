"""Physical-plan checks: pushdown, one Window node, no Python UDF on any query path."""
import datetime as dt
import os
import tempfile

from conftest import SMALL
from machinewatch.functions.time import prune_recent, resolve_as_of
from machinewatch.plans import catalogue
from machinewatch.plans.registry import sensor_data


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_filter_reaches_parquet_scan(spark):
    sd = sensor_data(spark, SMALL)
    plan = _plan(catalogue.machine_summary(sd, resolve_as_of(sd)))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan


def test_maintenance_trend_has_one_window(spark):
    sd = sensor_data(spark, SMALL)
    plan = _plan(catalogue.maintenance_trend(sd, resolve_as_of(sd)))
    assert plan.count("Window [") == 1


def test_catalogue_has_no_python_udf(spark):
    sd = sensor_data(spark, SMALL)
    as_of = resolve_as_of(sd)
    for name, fn in catalogue.CATALOGUE.items():
        plan = _plan(fn(sd, as_of))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_prune_recent_adds_partition_filter(spark):
    root = tempfile.mkdtemp(prefix="mw-prune-")
    sd = sensor_data(spark, SMALL)
    sd.write.partitionBy("year", "month", "day", "hour").parquet(os.path.join(root, "t"))
    stored = spark.read.parquet(os.path.join(root, "t"))
    plan = _plan(prune_recent(stored, dt.datetime(2024, 1, 30), "7d"))
    assert "PartitionFilters: [" in plan and "make_date" in plan
