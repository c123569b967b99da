"""Benchmark: the monitoring catalogue (Q1-Q18, RQ1-RQ2), the batch ETL and the
transform stream at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Then the scoring stream and the latency of one record. Default session
settings, but for as many shuffle partitions as CPUs.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
``value`` is the total seconds of the catalogue queries; each query's time
includes binding ``as_of`` (the latest event time) and running it to
completion.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from machinewatch.session import get_session  # noqa: E402


def _run(df) -> int:
    """Run a query to completion without moving its rows to the driver; returns their number."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    return int(seen.get["n"])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = get_session(f"local[{cpus}]", app_name="machinewatch-bench", shuffle_partitions=int(cpus),
                        extra={"spark.driver.memory": "16g"})

    from machinewatch.fixtures import load_readings
    from machinewatch.functions.time import resolve_as_of
    from machinewatch.plans import etl
    from machinewatch.plans.catalogue import CATALOGUE
    from machinewatch.plans.registry import sensor_data
    from machinewatch.sources import raw as rawsrc
    from machinewatch.streaming import sources as stream_sources
    from machinewatch.streaming import transform as stream_transform
    from machinewatch.operators import ml
    from machinewatch.operators.forest import load_forest
    from machinewatch.plans.registered import training_features
    from machinewatch.streaming import scoring

    # Warm-up: JVM, Parquet footers (not timed).
    sensor_data(spark, sf_dir).agg(F.count(F.lit(1))).collect()

    timings: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name, fn in CATALOGUE.items():
        t0 = time.perf_counter()
        sd = sensor_data(spark, sf_dir)
        rows[name] = _run(fn(sd, resolve_as_of(sd)))
        timings[name] = round(time.perf_counter() - t0, 3)

    scratch = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="mw-bench-")
    readings = load_readings(spark, sf_dir)
    n_readings = readings.count()

    t0 = time.perf_counter()
    etl_stats = etl.run_etl(spark, readings, os.path.join(scratch, "etl"))
    timings["etl"] = round(time.perf_counter() - t0, 3)

    # Transform stream (ST1): weekly arrivals of five-field records, one micro-batch each, statistics attached.
    lines = rawsrc.raw_bad(readings).withColumn(
        "week", F.date_trunc("week", F.col("event_timestamp")).cast("timestamp_ntz"))

    def streamed(name: str, start) -> float:
        """Seconds that the queries took, without staging the input."""
        spent = 0.0

        def timed(stream):
            nonlocal spent
            t = time.perf_counter()
            query = start(stream)
            query.awaitTermination()
            spent += time.perf_counter() - t
            return query

        stream_sources.run_arrivals(lines, os.path.join(scratch, name), "week", timed)
        return spent

    paths = stream_transform.TransformPaths(os.path.join(scratch, "stream-out"))
    stream_sec = streamed("stream-in", lambda stream: stream_transform.start_transform(stream, paths))
    timings["stream_transform"] = round(stream_sec, 3)

    # Scoring stream (ST2) with the saved forest of 100 trees as flat arrays; latency of one record.
    model_path = os.path.join(scratch, "model")
    # Trained on about 10,000 rows: what is timed is scoring.
    share = int(10_000 / max(n_readings, 1) * (1 << 20))
    sample = training_features(spark, sf_dir).filter(F.pmod(F.xxhash64("event_id"), F.lit(1 << 20)) < share)
    ml.save_model(ml.train_fixed(sample), model_path)
    model = load_forest(spark, model_path)
    score_sec = streamed("score-in", lambda stream: scoring.start_scoring(
        stream, model, os.path.join(scratch, "score-out")))
    timings["stream_score"] = round(score_sec, 3)
    one = lines.limit(1).select("raw").persist()
    one.count()
    latencies = []
    for _ in range(5):
        t0 = time.perf_counter()
        scoring.score_records(one, model).collect()
        latencies.append(time.perf_counter() - t0)
    one.unpersist()

    total = round(sum(timings[n] for n in CATALOGUE), 3)
    print(json.dumps({
        "metric": "catalogue_total_seconds",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "rows": rows,
        "readings": n_readings,
        "etl_records": etl_stats["total_records_processed"],
        "stream_records_per_sec": round(n_readings / stream_sec, 1) if stream_sec else None,
        "score_records_per_sec": round(n_readings / score_sec, 1) if score_sec else None,
        "score_one_record_ms": round(1000 * min(latencies), 1),
        "etl_records_per_sec": round(n_readings / timings["etl"], 1) if timings["etl"] else None,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
