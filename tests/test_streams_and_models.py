"""Models in a used session, streams over records without an id, bounded spines, edge rows."""
import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from machinewatch.fixtures import load_readings
from machinewatch.operators import ml, stats
from machinewatch.operators.enrich import event_time, feature_matrix
from machinewatch.plans import catalogue, etl
from machinewatch.plans.registry import sensor_data
from machinewatch.sinks.messages import alert_messages
from machinewatch.sources import raw as rawsrc
from machinewatch.streaming import scoring, sources, transform, windows


@pytest.fixture(scope="module")
def stored(spark):
    """The ETL has run (and observed its run) in this session before any model is used."""
    root = tempfile.mkdtemp(prefix="mw-etl-")
    return etl.run_etl(spark, load_readings(spark, SMALL), root, processing_time=False)["paths"]


def _features(spark):
    return feature_matrix(load_readings(spark, SMALL).dropna(subset=["temperature", "vibration", "pressure"]))


def test_model_survives_a_used_session(spark, stored):
    feats = _features(spark)
    model = ml.train_fixed(feats, num_trees=5, max_depth=4)
    fitted = {r["event_id"]: (r["prediction"], r["confidence"]) for r in ml.score(model, feats).collect()}
    path = tempfile.mkdtemp(prefix="mw-model-")
    ml.save_model(model, path)
    again = {r["event_id"]: (r["prediction"], r["confidence"]) for r in ml.score(ml.load_model(path), feats).collect()}
    assert fitted == again and len(again) == feats.count()


def test_rows_without_a_ratio_are_scored(spark):
    rows = [(i, float(20 + i), -0.001 if i % 5 == 0 else 0.5 + i / 50, 100.0 + i, float(i % 2)) for i in range(40)]
    df = feature_matrix(spark.createDataFrame(rows, "event_id long, temperature double, vibration double, pressure double, label double"))
    assert df.filter("temp_vib_ratio is null").count() == 8
    model = ml.train_fixed(df, num_trees=3, max_depth=3)
    assert ml.score(model, df).count() == 40


def test_grid_is_whole_and_its_rows_are_bounded(spark, monkeypatch):
    seen = {}

    class Search:
        def __init__(self, **params):
            seen.update(params)

        def fit(self, rows):
            seen["rows"] = rows.count()
            return type("Model", (), {"avgMetrics": [0.5] * len(seen["estimatorParamMaps"]), "bestModel": None})

    monkeypatch.setattr(ml, "CrossValidator", Search)
    monkeypatch.setattr(ml, "train_fixed", lambda rows, **params: params | {"rows": rows.count()})
    train = _features(spark)
    model, best, _ = ml.grid_search(train, max_rows=300)
    # The model that is kept is fitted on all rows with the best parameters.
    assert model["rows"] == train.count() and model["num_trees"] == best["numTrees"]
    assert len(seen["estimatorParamMaps"]) == 27 and seen["numFolds"] == 5
    assert 200 < seen["rows"] < 400
    ml.grid_search(train, max_rows=None)
    assert seen["rows"] == train.count()


def test_report_scans_once(spark, stored):
    scored = spark.read.parquet(stored.processed).select(
        F.col("label").alias("label"), (F.col("total_anomaly_score") >= 2).cast("int").alias("prediction"))
    plan = ml.classification_report(scored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def _device_rows(spark):
    """One machine has 90 % of the records; times tie, every tenth record arrives twice."""
    rows = [("hot" if i % 10 else f"m{i % 3}", 1_700_000_000 + i // 7, 20.0 + i % 13, 0.5 + i % 7, 90.0 + i % 11) for i in range(500)]
    rows += rows[::10]
    return spark.createDataFrame(rows, "machine_id string, timestamp long, temperature double, vibration double, pressure double"), rows


def test_statistics_reach_one_record_of_each_machine(spark):
    df, rows = _device_rows(spark)
    out = stats.attach_batch_stats(df, ["machine_id"], ts="timestamp")
    assert out.count() == len(rows) and out.columns[:5] == df.columns
    marked = {r["machine_id"]: r for r in out.filter("temp_mean is not null").collect()}
    assert out.filter("temp_mean is not null").count() == len(marked) == 4
    for machine, r in marked.items():
        own = sorted(x[1:] for x in rows if x[0] == machine)
        assert tuple(r)[1:5] == own[-1]
        assert r["temp_mean"] == pytest.approx(sum(x[1] for x in own) / len(own))


def test_a_null_machine_keeps_its_statistics(spark):
    df, _ = _device_rows(spark)
    out = stats.attach_batch_stats(df.withColumn("machine_id", F.lit(None).cast("string")), ["machine_id"], ts="timestamp")
    assert out.filter("temp_mean is not null").count() == 1


def test_held_statistics_are_sent_to_the_records(spark):
    df, rows = _device_rows(spark)
    groups = stats.latest_with_stats(df, ["machine_id"], ts="timestamp").coalesce(2).persist()
    assert groups.count() == 4
    out = stats.attach_batch_stats(df, ["machine_id"], ts="timestamp", groups=groups)
    # Records are shuffled nowhere: only the copies of a latest record, which met the groups before, are numbered.
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    assert sorted(map(str, out.collect())) == sorted(map(str, stats.attach_batch_stats(df, ["machine_id"], ts="timestamp").collect()))
    assert out.count() == len(rows) and out.filter("temp_mean is not null").count() == 4
    groups.unpersist()


def test_a_batch_is_written_as_it_arrived_and_replaced_whole(spark):
    df, rows = _device_rows(spark)
    records = transform.transform_records(rawsrc.raw_json(df.withColumn("event_id", F.lit(1)).withColumn(
        "event_timestamp", F.timestamp_seconds("timestamp"))).select("raw").coalesce(1))
    paths = transform.TransformPaths(tempfile.mkdtemp(prefix="mw-files-"))
    transform.make_batch_writer(paths)(records, 0)
    delivered = spark.read.parquet(paths.delivered)
    assert delivered.count() == len(rows) and dict(delivered.dtypes)["batch_id"] == "int"
    assert delivered.filter("temp_mean is not null").count() == 4
    # One part of records and one of latest records, not a file for each shuffle partition.
    assert len(delivered.inputFiles()) <= 2
    transform.write_batch(delivered.limit(3).localCheckpoint(), paths.delivered, 0)
    assert spark.read.parquet(paths.delivered).count() == 3
    transform.write_batch(delivered.limit(0).localCheckpoint(), paths.delivered, 0)
    assert spark.read.parquet(paths.delivered).count() == 0


def test_a_record_parsed_once_is_judged_as_before(spark):
    body = '"machine_id":"M","timestamp":1,"temperature":1,"vibration":1,"pressure":1'
    cases = [
        (f'{{"event_id":1,{body}}}', 1, None), (f'[{{"event_id":1,{body}}}]', None, "malformed_json"),
        (f'{{"event_id":xx,{body}}}', None, "malformed_json"), (f'{{"humidity":NaN,{body}}}', None, "malformed_json"),
        (f'{{"event_id":7,{body},"temperature":bad}}', None, "malformed_json"), (f'{{{body}', None, "malformed_json"),
        (f'  {{"event_id":"12",{body}}}', 12, None), (f'{{"event_id":3,"event_id":4,{body}}}', 3, None),
        (f'{{"_corrupt":"x","event_id":null,{body}}}', None, None), (None, None, "malformed_json"),
        ('{"event_id":2,"machine_id":"M","temperature":1,"vibration":1,"pressure":1}', 2, None),
        ('{"event_id":2,"machine_id":"M","timestamp":null,"temperature":1,"vibration":1,"pressure":1}', 2, "invalid_type:timestamp"),
        ('{"event_id":2,"machine_id":null,"timestamp":1,"vibration":1,"pressure":1}', 2, "missing_field:temperature"),
    ]
    frame = spark.createDataFrame([(i, raw) for i, (raw, _, _) in enumerate(cases)], "i int, raw string")
    got = {r.i: (r.event_id, r.reject_reason) for r in transform.transform_records(frame).collect()}
    assert [got[i] for i in range(len(cases))] == [(event, reason) for _, event, reason in cases]


def test_payload_stream_restarts_from_its_checkpoint(spark):
    """Base64 payloads through ST1, a batch at a time, then the same folder again without new files."""
    df, rows = _device_rows(spark)
    raw = rawsrc.stream_records(rawsrc.raw_json(df.withColumn("event_id", F.monotonically_increasing_id()).withColumn(
        "event_timestamp", F.timestamp_seconds("timestamp"))))
    lines = raw.select(F.to_json(F.struct("data", "body")).alias("raw"), (F.col("event_id") % 3).alias("part"))
    root = tempfile.mkdtemp(prefix="mw-payload-")
    paths = transform.TransformPaths(os.path.join(root, "out"))

    def start(stream):
        records = stream.select(F.from_json("raw", "data string, body string").alias("r")).select("r.*")
        return transform.start_transform(records, paths, payload=True)

    assert sources.run_arrivals(lines, root, "part", start) == 3
    start(sources.read_stream_text(spark, os.path.join(root, "input"))).awaitTermination()
    delivered = spark.read.parquet(paths.delivered)
    assert delivered.count() == len(rows)
    assert delivered.select("batch_id").distinct().count() == 3
    assert delivered.filter("temp_mean is not null").count() >= 3
    value = spark.read.json(paths.keyed).select(F.json_object_keys("value").alias("k")).first()["k"]
    assert "temp_vib_ratio" in value and "raw" not in value


def test_every_streamed_record_is_scored_or_rejected(spark, stored):
    model = ml.train_fixed(_features(spark), num_trees=3, max_depth=3)
    good = '{"machine_id":"A","timestamp":1700000000,"temperature":50,"vibration":1,"pressure":100}'
    lines = [good, '{"temperature":50,"vibration":1,"pressure":100}', '{"temperature":50,"vibration":-0.001,"pressure":100}',
             '{"machine_id":"A","timestamp":1700000000.5,"temperature":50,"vibration":1,"pressure":100}',
             '{"machine_id":"A","timestamp":"1.5","temperature":50,"vibration":1,"pressure":100}',
             '{"machine_id":"A","vibration":1,"pressure":100}', "not json", '{"temperature":"x","vibration":1,"pressure":1}']
    root = tempfile.mkdtemp(prefix="mw-score-")
    frame = spark.createDataFrame([(x, 0) for x in lines], "raw string, part int")
    sources.run_arrivals(frame, root, "part", lambda s: scoring.start_scoring(s, model, os.path.join(root, "out")))
    log = spark.read.json(root + "/out/batch_log").first()
    assert (log["records"], log["scored_records"], log["rejected_records"]) == (8, 4, 4)
    assert spark.read.json(root + "/out/errors").count() == 4
    metrics = spark.read.parquet(root + "/out/metrics")
    assert metrics.filter("metric_name = 'ProcessingDuration' and value > 0").count() == 4
    assert metrics.filter("dimension_value = 'unknown'").count() == 2 * 5


def test_an_empty_batch_writes_nothing(spark):
    paths = transform.TransformPaths(tempfile.mkdtemp(prefix="mw-empty-"))
    records = transform.transform_records(spark.createDataFrame([], "raw string"))
    transform.make_batch_writer(paths)(records, 0)
    assert os.listdir(paths.root) == []


def test_alert_of_an_unknown_machine(spark):
    row = spark.createDataFrame([(None, 1.0, 2.0, 3.0, 1)], "machine_id string, temperature double, vibration double, "
                                "pressure double, prediction int").withColumn("event_timestamp", F.current_timestamp())
    alert = alert_messages(row).first()
    assert alert["machine_id"] == "unknown" and '"machine_id":"unknown"' in alert["message"]


def test_a_time_in_milliseconds_does_not_stretch_the_spine(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start, 5), (start + dt.timedelta(hours=2), 500), (dt.datetime(9999, 1, 1), 1), (dt.datetime(1970, 1, 1), 1)]
    rollup = spark.createDataFrame(rows, "window_start timestamp_ntz, records long")
    got = windows.alarm_low_throughput(rollup).orderBy("window_start").collect()
    assert [r["window_start"] for r in got] == [start + dt.timedelta(minutes=5 * i) for i in range(25)]
    assert [r["alarm"] for r in got] == [False, *[True] * 23, False]


def test_late_router_reports_a_broken_state(spark):
    root = tempfile.mkdtemp(prefix="mw-late-")
    batch = spark.createDataFrame([(1, dt.datetime(2024, 1, 3))], "event_id long, event_time timestamp_ntz")
    route = windows.late_router(root)
    route(batch, 0)
    route(batch.withColumn("event_time", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")), 1)
    assert spark.read.parquet(root + "/late").count() == 1 and spark.read.parquet(root + "/on_time").count() == 1
    for folder, _, names in os.walk(root + "/state"):
        for name in names:
            if name.endswith(".parquet"):
                with open(os.path.join(folder, name), "wb") as f:
                    f.write(b"broken")
    with pytest.raises(Exception, match="(?i)parquet|footer|read"):
        route(batch, 2)


def test_all_ratings_and_categories(spark):
    values = [("e", 50.0, 1.0, 100.0), ("g", 65.0, 1.7, 130.0), ("f", 75.0, 2.2, 150.0), ("p", 90.0, 3.0, 170.0)]
    at = dt.datetime(2024, 1, 5, 12)
    rows = [(*v, at) for v in values]
    df = spark.createDataFrame(rows, "machine_id string, temperature double, vibration double, pressure double, event_timestamp timestamp_ntz")
    from machinewatch.operators.enrich import derive_features

    sd = derive_features(df, processing_time=False)
    ratings = {r["machine_id"]: r["efficiency_rating"] for r in catalogue.efficiency_ranking(sd, at).collect()}
    assert ratings == {"e": "EXCELLENT", "g": "GOOD", "f": "FAIR", "p": "POOR"}
    energy = {r["machine_id"]: r["efficiency_category"] for r in catalogue.energy_efficiency(sd, at).collect()}
    assert energy == {"e": "ENERGY_EFFICIENT", "g": "MODERATE_EFFICIENCY", "f": "HIGH_ENERGY_USAGE", "p": "HIGH_ENERGY_USAGE"}


def test_catalogue_skips_folders_of_the_stored_table(spark, stored):
    table = spark.read.parquet(stored.processed)
    as_of = dt.datetime(2024, 1, 30)
    bounded = 0
    for name, fn in catalogue.CATALOGUE.items():
        plan = fn(table, as_of)._jdf.queryExecution().executedPlan().toString()
        if "event_timestamp" in plan and "GreaterThanOrEqual(event_timestamp" in plan:
            assert "make_date" in plan.split("PartitionFilters: [")[1].split("]")[0], name
            bounded += 1
    assert bounded >= 18


def test_stored_files_are_sorted(spark, stored):
    """Machines and times ascend within each file."""
    rows = spark.read.parquet(stored.processed).select(
        F.input_file_name().alias("f"), "machine_id", "event_timestamp", F.monotonically_increasing_id().alias("i"))
    by_file = {}
    for r in rows.orderBy("i").collect():
        by_file.setdefault(r["f"], []).append((r["machine_id"], r["event_timestamp"]))
    assert len(by_file) > 100 and all(v == sorted(v) for v in by_file.values())


def test_event_time_without_a_timestamp_column(spark):
    row = event_time(spark.range(1)).first()
    assert abs((row["event_timestamp"] - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 600


def test_processing_time_is_now(spark):
    from machinewatch.operators.enrich import derive_features

    sd = derive_features(load_readings(spark, SMALL).limit(1))
    assert sd.select((F.abs(F.unix_timestamp("processing_timestamp") - F.unix_timestamp(F.current_timestamp())) < 600)).first()[0]


def test_raw_lake_to_features(spark):
    """The ETL from JSON files: raw lake -> event time -> features equals the features of the readings."""
    readings = load_readings(spark, SMALL)
    path = tempfile.mkdtemp(prefix="mw-raw-") + "/lake"
    rawsrc.raw_json(readings).select("raw").write.text(path)
    paths = etl.run_etl(spark, rawsrc.read_raw(spark, path), tempfile.mkdtemp(prefix="mw-etl-raw-"), processing_time=False)["paths"]
    cols = ["machine_id", "temperature", "temp_vib_ratio", "total_anomaly_score", "year", "month", "day", "hour"]
    got = spark.read.parquet(paths.processed).select(cols)
    want = sensor_data(spark, SMALL).select(cols)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_the_lag_bucket_follows_the_fullest_group(spark):
    from machinewatch.operators.enrich import choose_bucket, lag_features

    readings = load_readings(spark, SMALL)
    by_day = readings.groupBy("machine_id", F.to_date("event_timestamp")).count().agg(F.max("count")).first()[0]
    assert choose_bucket(readings, limit=by_day) == "day"
    assert choose_bucket(readings, limit=by_day - 1) == "hour"
    assert choose_bucket(readings, limit=0) == "second"
    assert choose_bucket(readings.filter("false")) == "day"
    want = lag_features(readings, bucket=None).select("event_id", "temp_lag_1", "temp_diff")
    got = lag_features(readings, bucket="second").select("event_id", "temp_lag_1", "temp_diff")
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_stream_alarm_errors_judges_every_window(spark):
    """The whole rollup, its newest window included."""
    from machinewatch.plans import registered

    windows = {r[0] for r in registered._stream_rollup(spark, "/root/testdata/sf0.001").select("window_start").collect()}
    judged = {r[0] for r in registered.q_stream_alarm_errors(spark, "/root/testdata/sf0.001").select("window_start").collect()}
    assert judged == windows and windows
