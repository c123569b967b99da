"""Redelivery, mergeable distinct counts, closed-period alarms, trigger progress, bounded delivery, record boundaries, lag ranges."""
import datetime as dt
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from check_oracle import compare
from conftest import SMALL
from machinewatch.fixtures import load_readings
from machinewatch.operators import distinct, enrich
from machinewatch.operators.ranges import in_ranges, running_offsets
from machinewatch.sinks.files import session_conf
from machinewatch.sources import crawl, records
from machinewatch.streaming import alarms, dedupe, delivery, progress, sources, transform, windows

LIVE = ["stream_dedup", "distinct_devices", "live_alarms", "closed_alarms", "stream_dashboard", "stream_delivery",
        "scan_json_records", "lag_features", "schema_drift"]


@pytest.mark.parametrize("name", LIVE)
def test_matches_oracle(spark, name):
    status, detail = compare(spark, SMALL, [name], verbose=False)[name]
    assert status == "OK", detail


def _root(name):
    return tempfile.mkdtemp(prefix=f"mw-{name}-")


# --- redelivery ----------------------------------------------------------------------------------

def _line(machine, at, temperature=50, event=None):
    head = f'"event_id":{event},' if event is not None else ""
    return f'{{{head}"machine_id":"{machine}","timestamp":{at},"temperature":{temperature},"vibration":1,"pressure":100}}'


def test_a_redelivered_record_counts_once_and_a_late_one_counts(spark):
    rows = [(_line("A", 1_700_000_000), 0), (_line("A", 1_700_000_000), 0), (_line("A", 1_700_000_000), 2), (_line("B", 1_700_000_000), 1),
            (_line("A", 100), 2), (_line("A", 100), 3), (_line("C", 5, 50, event=7), 0), (_line("C", 5, 60, event=7), 3),
            ("not json", 0), ("not json", 1)]
    root = _root("dedup")
    paths = transform.TransformPaths(os.path.join(root, "out"))
    sources.run_arrivals(spark.createDataFrame(rows, "raw string, part int"), root, "part",
                         lambda s: transform.start_transform(s, paths, redelivered_within="24 hours"))
    got = sorted((r["machine_id"], r["timestamp"], r["temperature"]) for r in spark.read.parquet(paths.delivered).collect())
    assert got == [("A", 100, 50.0), ("A", 1_700_000_000, 50.0), ("B", 1_700_000_000, 50.0), ("C", 5, 50.0)]
    assert spark.read.json(paths.errors).count() == 1


def test_without_the_safeguard_every_delivery_counts(spark):
    root = _root("dedup-off")
    paths = transform.TransformPaths(os.path.join(root, "out"))
    frame = spark.createDataFrame([(_line("A", 100), 0), (_line("A", 100), 1)], "raw string, part int")
    sources.run_arrivals(frame, root, "part", lambda s: transform.start_transform(s, paths))
    assert spark.read.parquet(paths.delivered).count() == 2


def test_keys_of_batch_records(spark):
    frame = spark.createDataFrame([(None, "x"), (None, "x"), (None, "y"), ("{}", None), ("{}", None), (None, None), (None, None)],
                                  "raw string, body string")
    assert dedupe.drop_redelivered(frame).count() == 4
    assert dedupe.drop_redelivered(frame.select("body"), key=F.coalesce("body", F.lit(""))).columns == ["body"]


# --- distinct counts -----------------------------------------------------------------------------

def test_sketches_unite_within_their_bound(spark):
    rows = spark.range(200_000).select(
        (F.col("id") % 30_000).alias("device"), F.lit(2024).alias("year"), F.lit(1).alias("month"),
        (1 + F.col("id") % 3).cast("int").alias("day"), (F.col("id") % 5).cast("int").alias("hour"))
    sketches = distinct.hourly_sketches(rows, "device")
    assert sketches.count() == 15
    path = _root("sketches")
    distinct.write_sketches(sketches, path)
    stored = distinct.read_sketches(spark, path)
    for by in ([], ["day"], ["day", "hour"]):
        both = distinct.distinct_counts(stored, by)
        exact = {tuple(r[c] for c in by): r["distinct_exact"] for r in distinct.exact_distinct(rows, "device", by).collect()}
        out = both.collect()
        assert len(out) == len(exact)
        for r in out:
            want = exact[tuple(r[c] for c in by)]
            assert abs(r["distinct_estimate"] - want) <= 3 * distinct.standard_error() * want
            assert r["distinct_low"] <= want <= r["distinct_high"]


def test_a_late_hour_replaces_its_own_sketch(spark):
    schema = "machine_id string, year int, month int, day int, hour int"
    first = [("a", 2024, 1, 1, 0), ("b", 2024, 1, 1, 0), ("a", 2024, 1, 1, 1), (None, 2024, 1, 2, 5)]
    path = _root("sketches-late")
    distinct.write_sketches(distinct.hourly_sketches(spark.createDataFrame(first, schema), "machine_id"), path)
    late = [("a", 2024, 1, 1, 1), ("c", 2024, 1, 1, 1), ("d", 2024, 1, 1, 1)]
    distinct.write_sketches(distinct.hourly_sketches(spark.createDataFrame(late, schema), "machine_id"), path)

    def count(**window):
        rows = distinct.distinct_counts(distinct.read_sketches(spark, path, **window)).collect()
        return (rows[0]["records"], rows[0]["distinct_estimate"]) if rows else None

    at = dt.datetime(2024, 1, 1)
    assert count() == (6, 4)
    assert count(since=at, until=at + dt.timedelta(hours=1)) == (2, 2)
    assert count(since=at + dt.timedelta(hours=1), until=at + dt.timedelta(days=1)) == (3, 3)
    assert count(since=at + dt.timedelta(days=1)) == (1, 0)
    assert count(since=at + dt.timedelta(days=9)) is None
    with session_conf(spark, {"spark.sql.maxMetadataStringLength": "1000"}):
        plan = distinct.read_sketches(spark, path, since=at)._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


# --- alarms --------------------------------------------------------------------------------------

def _periods(start, counts):
    """Records of each period: (good, bad)."""
    rows = []
    for i, (good, bad) in enumerate(counts):
        at = start + 300 * i
        rows += [(_line("A", at + j % 300), 0) for j in range(good)]
        rows += [('{"machine_id":"A","timestamp":%d}' % (at + j % 300), 0) for j in range(bad)]
    return rows


def _run_alarms(spark, rows, root, **options):
    frame = spark.createDataFrame(rows, "raw string, part int")

    def start(stream):
        recs = transform.transform_records(stream).withColumn("event_time", F.timestamp_seconds("timestamp"))
        return alarms.start_alarms(recs, os.path.join(root, "out"), **options)

    sources.run_arrivals(frame, root, "part", start)
    out = spark.read.parquet(root + "/out/periods").select(
        F.unix_seconds("window_start").alias("s"), "records", "errors", "errors_alarm", "low_input_alarm").orderBy("s").collect()
    return [tuple(r) for r in out]


START = 1_700_000_100 // 300 * 300


def test_an_open_period_raises_no_alarm(spark):
    counts = [(120, 0), (50, 0), (120, 0), (30, 8), (90, 7), (0, 0), (0, 0), (120, 6), (3, 0)]
    root = _root("alarms")
    got = _run_alarms(spark, _periods(START, counts), root, delay=0)
    want = [(120, 0, False, False), (50, 0, False, False), (120, 0, False, False), (38, 8, False, False), (97, 7, True, True),
            (0, 0, False, True), (0, 0, False, True), (126, 6, False, False)]
    assert got == [(START + 300 * i, *w) for i, w in enumerate(want)]
    assert spark.read.parquet(root + "/out/alarms").count() == 3


def test_alarms_go_on_after_restarts_and_gaps(spark):
    """Six arrivals, each a new run from the checkpoint, give what one table gives; gaps and delays included."""
    rng = random.Random(4)
    rows, at = [], START
    for part in range(6):
        for _ in range(30):
            at += rng.choice([1, 20, 100, 700, 2500])
            rows.append((_line("A", at) if rng.random() < 0.7 else '{"machine_id":"A","timestamp":%d}' % at, part))
    rows += [(_line("A", 10 ** 12), 2), ('{"machine_id":"A","timestamp":null}', 1)]
    got = _run_alarms(spark, rows, _root("alarms-restart"), error_threshold=0, low_threshold=2)
    frame = transform.transform_records(spark.createDataFrame(rows, "raw string, part int")).withColumn(
        "event_time", F.timestamp_seconds("timestamp"))
    want = [tuple(r) for r in alarms.closed_alarms(frame, error_threshold=0, low_threshold=2).select(
        F.unix_seconds(F.col("window_start").cast("timestamp")).alias("s"), "records", "errors", "errors_alarm",
        "low_input_alarm").orderBy("s").collect()]
    assert got == want and len(got) > 100
    assert {r[3] for r in got} == {r[4] for r in got} == {True, False}


def test_each_machine_can_have_its_own_alarms(spark):
    rows = [(_line(m, START + 300 * i), 0) for m, last in (("A", 9), ("B", 2)) for i in range(last)]
    root = _root("alarms-key")
    frame = spark.createDataFrame(rows, "raw string, part int")

    def start(stream):
        recs = transform.transform_records(stream).withColumn("event_time", F.timestamp_seconds("timestamp"))
        return alarms.start_alarms(recs, root + "/out", key=F.col("machine_id"), low_threshold=1, delay=0)

    sources.run_arrivals(frame, root, "part", start)
    silent = spark.read.parquet(root + "/out/alarms").groupBy("alarm_key").count().collect()
    # B is silent from its third period on: the second silent period, and all closed ones after it, are alarms.
    assert [tuple(r) for r in silent] == [("B", 5)]


def test_no_period_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "raw string, event_time timestamp, is_valid boolean")
    assert alarms.closed_alarms(frame).collect() == []


def test_the_newest_window_is_open(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(minutes=5 * i), start + dt.timedelta(minutes=5 * i + 5), n, 0)
            for i, n in ((0, 500), (1, 5), (2, 500), (3, 4), (4, 3))] + [(dt.datetime(9999, 1, 1), dt.datetime(9999, 1, 1, 0, 5), 1, 0)]
    rollup = spark.createDataFrame(rows, "window_start timestamp_ntz, window_end timestamp_ntz, records long, errors long")
    got = windows.alarm_low_throughput(windows.closed_windows(rollup)).orderBy("window_start").collect()
    assert [(r["records"], r["breach"], r["alarm"]) for r in got] == [
        (500, False, False), (5, True, False), (500, False, False), (4, True, False)]
    assert windows.closed_windows(rollup, 300).count() == 3
    assert windows.closed_windows(rollup.filter("false")).count() == 0


def test_the_late_router_reads_one_state(spark):
    root = _root("late-gap")
    route = windows.late_router(root)

    def batch(day):
        return spark.createDataFrame([(1, dt.datetime(2024, 1, day))], "event_id long, event_time timestamp_ntz")

    for i, day in ((0, 9), (1, 3), (7, 7), (8, 8)):
        route(batch(day), i)
    # Batch 7 follows a gap: its predecessor is batch 1, which carried the newest time on.
    late = {r["batch_id"] for r in spark.read.parquet(root + "/late").collect()}
    assert late == {1, 7} and windows._state_before(spark, root + "/state", 7) == 1
    assert windows._state_before(spark, root + "/state", 0) is None


# --- progress ------------------------------------------------------------------------------------

def test_progress_equals_the_batches(spark):
    rows = [(_line("A", START + i), i % 3) for i in range(30)] + [("not json", 1)] * 4
    root = _root("progress")
    table = progress.ProgressTable(spark, root + "/progress")
    runs = []

    def start(stream):
        recs = transform.transform_records(stream).withColumn("event_time", F.timestamp_seconds("timestamp"))
        runs.append(windows.start_rollup(recs, root, observe=table.name))
        return runs[-1]

    sources.run_arrivals(spark.createDataFrame(rows, "raw string, part int"), root, "part", start)
    table.close(*runs)
    seen = progress.read_progress(spark, root + "/progress").filter("input_rows > 0").orderBy("batch_id").collect()
    assert [(r["records"], r["errors"]) for r in seen] == [(10, 0), (14, 4), (10, 0)]
    assert all(r["duration_ms"] > 0 and r["lag_ms"] > 0 and r["bytes"] > 0 for r in seen)
    periods = progress.slow_triggers(progress.read_progress(spark, root + "/progress"), limit_ms=0).collect()
    assert sum(r["records"] for r in periods) == 34 and all(r["slow"] for r in periods)
    board = progress.dashboard(spark, root)
    assert board.filter("duration_ms is null").count() == 0 and board.count() == windows.read_rollup(spark, root).count()


def test_a_failed_progress_write_is_reported(spark):
    table = progress.ProgressTable(spark, "nowhere://x")
    table._rows.put(("q", "r", 0, "2024-01-01T00:00:00.000Z", 1, 1, 1, 1, 0, 1, None))
    with pytest.raises(Exception, match="nowhere"):
        table.close()


# --- delivery ------------------------------------------------------------------------------------

def _batch(spark, values, hours=1):
    rows = [(v, 2024, 1, 1, i % hours) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value string, year int, month int, day int, hour int")


def _delivered(spark, root):
    return sorted(r["value"] for r in delivery.read_delivered(spark, root).collect())


def test_files_are_bounded_and_full(spark):
    rng = random.Random(1)
    values = ["x" * rng.randint(1, 300) for _ in range(3000)] + ["é" * 400, "y" * 999, "z" * 5000] + ["same"] * 500
    root = _root("delivery")
    assert delivery.deliver(_batch(spark, values, hours=2), 0, root, max_bytes=2000)
    assert _delivered(spark, root) == sorted(values)
    sizes = [r["bytes"] for r in delivery.file_sizes(spark, root).collect()]
    assert sorted(sizes)[-2] <= 2000 and max(sizes) == 5001
    # A cell is a file's length less the longest row that is not on its own.
    assert len(sizes) <= sum(len(v.encode()) + 1 for v in values) / 1000 + 3


def test_a_replayed_batch_and_an_interrupted_one(spark, monkeypatch):
    root = _root("delivery-replay")
    assert delivery.deliver(_batch(spark, ["a", "b"]), 0, root) and not delivery.deliver(_batch(spark, ["a", "b"]), 0, root)
    swap = delivery.swap_manifest
    monkeypatch.setattr(delivery, "swap_manifest", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        delivery.deliver(_batch(spark, ["c"]), 1, root)
    assert _delivered(spark, root) == ["a", "b"]
    monkeypatch.setattr(delivery, "swap_manifest", swap)
    assert delivery.deliver(_batch(spark, ["c"]), 1, root)
    assert _delivered(spark, root) == ["a", "b", "c"]


def test_compaction_loses_and_doubles_nothing(spark, monkeypatch):
    root = _root("delivery-compact")
    for i in range(4):
        delivery.deliver(_batch(spark, [f"{i}-{j}" for j in range(50)], hours=3), i, root, max_bytes=100)
    rows = _delivered(spark, root)
    before = delivery.read_manifest(spark, root)
    swap = delivery.swap_manifest

    def dies(*args):
        raise RuntimeError("interrupted")

    monkeypatch.setattr(delivery, "swap_manifest", dies)
    with pytest.raises(RuntimeError, match="interrupted"):
        delivery.compact(spark, root, max_bytes=100)
    assert delivery.read_manifest(spark, root) == before and _delivered(spark, root) == rows

    # A delivery that comes between the compaction's read and its swap stays.
    def raced(spark_, root_, old, live):
        monkeypatch.setattr(delivery, "swap_manifest", swap)
        delivery.deliver(_batch(spark, ["meanwhile"]), 9, root)
        swap(spark_, root_, old, live)

    monkeypatch.setattr(delivery, "swap_manifest", raced)
    assert delivery.compact(spark, root, max_bytes=100)
    after = delivery.read_manifest(spark, root)
    assert _delivered(spark, root) == sorted([*rows, "meanwhile"])
    assert sorted(i for ids in after.live.values() for i in ids) == [0, 1, 2, 3, 9] and len(after.live) == 2
    assert max(r["bytes"] for r in delivery.file_sizes(spark, root).collect()) <= 100
    # What was compacted is still known as delivered, and only dead folders can be removed.
    assert not delivery.deliver(_batch(spark, ["0-0"]), 2, root)
    with pytest.raises(ValueError, match="still live"):
        delivery.remove_dead(spark, root, list(after.live))
    delivery.remove_dead(spark, root, list(before.live))
    assert _delivered(spark, root) == sorted([*rows, "meanwhile"])


def test_two_writers_cannot_take_one_version(spark):
    root = _root("delivery-race")
    old = delivery.read_manifest(spark, root)
    delivery.swap_manifest(spark, root, old, {"a": [0]})
    with pytest.raises(delivery.Conflict):
        delivery.swap_manifest(spark, root, old, {"b": [1]})
    assert delivery.read_manifest(spark, root).live == {"a": [0]}
    assert not [n for n in os.listdir(root + "/manifest") if n.startswith(".") and not n.endswith(".crc")]


def test_nothing_was_delivered(spark):
    root = _root("delivery-none")
    assert _delivered(spark, root) == [] and not delivery.compact(spark, root)


# --- record boundaries ---------------------------------------------------------------------------

def _write(text, name="in.json"):
    folder = _root("records")
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return folder


def _raws(spark, path):
    return [r["raw"] for r in records.json_records(spark, path).orderBy("file", "record").collect()]


HARD = [{"machine_id": "a}{b", "n": {"x": {"y": [1, {"z": "}"}]}}}, {"q": "\"}{\\\"", "e": "\\"}, {}, {"s": "{{{"}, {"é\U0001f600}": "\n\t\\\\\""},
        {"deep": {"a": {"b": {"c": {"d": "}}}}"}}}}}]


@pytest.mark.parametrize("sep", ["", " ", "\n", ",\n", "\r\n"])
def test_records_come_back_whole(spark, sep):
    want = [json.dumps(r, ensure_ascii=False) for r in HARD * 40]
    for end in ("", sep):
        with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "1"}):
            assert _raws(spark, _write(sep.join(want) + end)) == want


def test_one_line_is_read_by_several_tasks(spark):
    rng = random.Random(2)
    want = [json.dumps({"id": i, "text": "".join(rng.choice('ab{}"\\ ') for _ in range(rng.randint(0, 200)))}) for i in range(3000)]
    path = _write("".join(want))
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "16384", "spark.sql.files.openCostInBytes": "1"}):
        assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 10
        assert _raws(spark, path) == want


def test_broken_input_is_kept_as_records(spark):
    assert _raws(spark, _write('{"a":1}}{"b":2}junk{"c":3}{"open":{"x":1}')) == [
        '{"a":1}', "}", '{"b":2}', 'junk{"c":3}', '{"open":{"x":1}']
    assert _raws(spark, _write('{"a":1} tail')) == ['{"a":1}', "tail"]
    assert _raws(spark, _write("")) == [] == _raws(spark, _write(" \n "))


def test_several_files_and_gzip(spark):
    import gzip

    folder = _write('{"f":1}{"f":"}"}', "a.json")
    with gzip.open(os.path.join(folder, "b.json.gz"), "wt") as f:
        f.write('{"f":3}{"f":{"g":4}}')
    assert sorted(_raws(spark, folder)) == sorted(['{"f":1}', '{"f":"}"}', '{"f":3}', '{"f":{"g":4}}'])
    rows = records.read_json_records(spark, _write('{"machine_id":"a}{b","temperature":1.5}{"machine_id":"c"}')).collect()
    assert sorted((r["machine_id"], r["temperature"]) for r in rows) == [("a}{b", 1.5), ("c", None)]


# --- lag over ranges -----------------------------------------------------------------------------

def _hot(spark):
    rows = [("hot" if i % 10 else None if i % 20 else f"m{i % 7}", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i // 3), i,
             float(i % 13) if i % 11 else None, float(i % 5), float(i % 3)) for i in range(4000)]
    return spark.createDataFrame(rows, "machine_id string, event_timestamp timestamp_ntz, event_id long, temperature double, "
                                 "vibration double, pressure double")


def test_lag_over_ranges_equals_the_window(spark):
    cols = ["event_id", "temp_lag_1", "vib_lag_1", "pressure_lag_1", "temp_diff", "vib_diff", "pressure_diff"]
    for df in (_hot(spark), load_readings(spark, SMALL), _hot(spark).limit(1), _hot(spark).filter("false")):
        want = enrich.lag_features(df, bucket=None).select(cols)
        got = enrich.lag_features(df).select(cols)
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    assert enrich.lag_features(_hot(spark)).columns[:6] == _hot(spark).columns


def test_lag_is_one_scan_and_one_shuffle_and_spreads_a_hot_machine(spark):
    path = _root("lag-input") + "/rows"
    _hot(spark).write.parquet(path)
    passed = enrich.lag_pass(spark.read.parquet(path), ["event_timestamp", "event_id"])
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange ") == 1
    sizes = [r["count"] for r in passed.filter("machine_id = 'hot'").groupBy("_part").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_offsets_over_ranges(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    ranged = in_ranges(df, [F.col("k"), F.col("v")], _root("ranges") + "/r")
    offsets = {(r["k"], r["part"]): r["offset"] for r in running_offsets(ranged, F.lit(1), ["k"]).collect()}
    rows = sorted((r["k"], r["v"], r["part"]) for r in ranged.collect())
    for k in range(3):
        own = [p for key, _, p in rows if key == k]
        assert own == sorted(own)
        assert all(offsets[k, p] == own.index(p) for p in set(own))


# --- schema with drift ---------------------------------------------------------------------------

def _land(path, folder, lines, name="part.json"):
    os.makedirs(os.path.join(path, folder), exist_ok=True)
    with open(os.path.join(path, folder, name), "w") as f:
        f.write("\n".join(lines))


def test_drift_is_reported_and_only_new_folders_are_read(spark, monkeypatch):
    path, store = _root("drift"), _root("drift-store")
    day = "year=2024/month={}/day=1/hour=0".format
    _land(path, day(2), ['{"a":1,"b":1.5,"gone":"x"}', '{"a":2,"n":null}', "not json", ""])
    assert crawl.crawl(spark, path, store) == [day(2)]
    _land(path, day(10), ['{"a":"text","b":2,"late":{"x":[1]}}', "[1]"])
    _land(path, day(11), ['{"a":3,"b":2.25,"odd `name":true}'])
    read = []
    lines = crawl.folder_types
    monkeypatch.setattr(crawl, "folder_types", lambda df: read.append(sorted(r[0] for r in df.select("month").distinct().collect())) or lines(df))
    assert crawl.crawl(spark, path, store) == [day(10), day(11)] and read == [[10, 11]]
    assert crawl.crawl(spark, path, store) == []
    got = {r["column_name"]: r for r in crawl.lake_schema(spark, store).collect()}
    kinds = {c: (r["data_type"], r["types"], r["records"], r["changed_type"], r["appeared_late"], r["vanished"]) for c, r in got.items()}
    assert kinds == {
        "a": ("string", "bigint,string", 4, True, False, False), "b": ("double", "bigint,double", 3, True, False, False),
        "gone": ("string", "string", 1, False, False, True), "n": ("string", "", 1, False, False, True),
        "late": ("struct<x: array<bigint>>", "struct<x: array<bigint>>", 1, False, True, True),
        "odd `name": ("boolean", "boolean", 1, False, True, False), "_corrupt": ("string", "", 2, False, False, True)}
    assert got["late"]["first_seen"] == dt.datetime(2024, 10, 1)
    # A folder that changes is read again, and its counts replaced.
    _land(path, day(11), ['{"a":4}', '{"a":5}'], "more.json")
    assert crawl.crawl(spark, path, store) == [day(11)]
    assert crawl.lake_schema(spark, store).filter("column_name = 'a'").first()["records"] == 6
    assert spark.read.schema(crawl.schema_ddl(spark, store)).json(path).filter("a = '4'").count() == 1


def test_an_interrupted_crawl_is_done_again(spark, monkeypatch):
    path, store = _root("drift-dies"), _root("drift-dies-store")
    _land(path, "year=2024/month=1/day=1/hour=5", ['{"a":1}'])
    keys = crawl._keys_of
    monkeypatch.setattr(crawl, "_keys_of", lambda f: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        crawl.crawl(spark, path, store)
    monkeypatch.setattr(crawl, "_keys_of", keys)
    assert len(crawl.crawl(spark, path, store)) == 1
    assert [r["records"] for r in crawl.lake_schema(spark, store).collect()] == [1]
    assert crawl.crawl(spark, _root("drift-empty"), _root("drift-empty-store")) == []
