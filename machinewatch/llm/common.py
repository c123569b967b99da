"""Helpers shared by the training-data operators.

Operators read only the columns they are told to use and return their own
columns, so extra columns of the input, also ones named like a result, never
clash with them.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from machinewatch.session import configure, scratch_path

#: Rows that Spark hands to a Python worker at once; texts average a few kB.
ARROW_ROWS = 1000

_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
    "string": pa.string(), "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators: UTC, AQE and small Arrow batches."""
    configure(spark)
    # Python workers started from another folder find this package where the driver has it.
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run's intermediate table, in the shared checkpoint folder."""
    return scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder: cuts the lineage, survives lost executors."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name in df.columns:
        name += "_"
    return name


def crc_mod(doc_id: Column, n: int) -> Column:
    """Fold of a document: crc32 of its id as text, modulo ``n``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def arrow_schema(ddl: str) -> pa.Schema:
    fields = (f.strip().rsplit(" ", 1) for f in ddl.split(","))
    return pa.schema([(name, _ARROW[kind]) for name, kind in fields])


def map_rows(df: DataFrame, ddl: str, start: Callable[[], Callable[[Iterator[tuple]], Iterator[tuple]]],
             batch_rows: int = ARROW_ROWS, batch_bytes: int = 16 << 20) -> DataFrame:
    """Run a generator over each partition's rows (tuples in, tuples out).

    ``start()`` is called once per task and returns the generator function.
    Output leaves in batches of at most ``batch_rows`` rows and about
    ``batch_bytes`` bytes of strings, so a worker holds little at a time.
    """
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def flush(out: list[tuple]) -> pa.RecordBatch:
            cols = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        out, size = [], 0
        for row in start()(rows()):
            out.append(row)
            size += sum(len(v) for v in row if isinstance(v, (str, bytes)))
            if len(out) >= batch_rows or size >= batch_bytes:
                yield flush(out)
                out, size = [], 0
        if out:
            yield flush(out)

    return df.mapInArrow(run, ddl)


def per_text(ddl: str, start: Callable[[], Callable[[str | None], tuple]]):
    """A scalar Pandas UDF: one struct ``ddl`` per value of a text column.

    ``start()`` builds the function once per task. Only that column goes to
    Python; the row's other columns stay in the JVM.
    """
    names = [f.strip().rsplit(" ", 1)[0] for f in ddl.split(",")]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = start()
        for texts in batches:
            yield pd.DataFrame([one(t if isinstance(t, str) else None) for t in texts], columns=names)

    # The evaluation type follows from these hints.
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, ddl)


def with_struct(df: DataFrame, keys: list[str], udf, value: str) -> DataFrame:
    """The columns ``keys`` and the fields of ``udf(value)``, evaluated once per row."""
    return df.select(*keys, udf(F.col(value)).alias("_r")).select(*keys, "_r.*")
