"""Registry of named queries over the driver's tables, and their oracle SQL.

Every query reads the given tables (``events`` through the readings adapter)
so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from machinewatch.fixtures import load_readings
from machinewatch.functions.time import resolve_as_of
from machinewatch.operators.enrich import derive_features
from machinewatch.plans.catalogue import CATALOGUE
from machinewatch.plans.oracle_catalogue import catalogue_sql

QueryFn = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        _REGISTRY[name] = fn
        if oracle is not None:
            _ORACLE[name] = oracle
        return fn

    return wrap


def sensor_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed readings without the wall-clock column (deterministic output)."""
    return derive_features(load_readings(spark, sf_dir), processing_time=False)


def _catalogue_query(fn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sd = sensor_data(spark, sf_dir)
        return fn(sd, resolve_as_of(sd))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


_CAT_SQL = catalogue_sql()
for _name, _fn in CATALOGUE.items():
    register(_name, _CAT_SQL[_name])(_catalogue_query(_fn))


def _load_all() -> None:
    # Import for side effects: each module registers its queries.
    from machinewatch.plans import live, registered  # noqa: F401


def _configured(fn: QueryFn) -> QueryFn:
    """Apply the session settings (UTC, AQE, dynamic overwrite) before building the query."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from machinewatch.session import configure

        configure(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {name: _configured(fn) for name, fn in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)
