"""Model: AUC > 0.9 on a separable two-class fixture, save/load gives equal predictions."""
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from machinewatch.operators import ml
from machinewatch.operators.enrich import feature_matrix
from machinewatch.operators.forest import load_forest


def _separable(spark, n=2000):
    base = spark.range(n).withColumn("label", (F.col("id") % 2).cast("int"))
    anomal = F.col("label") == 1
    df = base.select(
        F.col("id").alias("event_id"), "label",
        F.when(anomal, 80 + 15 * F.randn(1)).otherwise(60 + 10 * F.randn(2)).alias("temperature"),
        F.when(anomal, 2.5 + 0.8 * F.randn(3)).otherwise(1.0 + 0.3 * F.randn(4)).alias("vibration"),
        F.when(anomal, 150 + 25 * F.randn(5)).otherwise(100 + 15 * F.randn(6)).alias("pressure"))
    return feature_matrix(df)


def test_training_auc_and_roundtrip(spark):
    feats = _separable(spark).cache()
    out = tempfile.mkdtemp(prefix="mw-model-")
    res = ml.training_run(feats, out)
    assert res["roc_auc"] > 0.9 and res["accuracy"] > 0.8
    again = ml.load_model(res["model_path"])
    a = ml.score(again, feats).select("event_id", "prediction").orderBy("event_id").collect()
    split = ml.stratified_split(feats)
    assert split.filter("split = 'test'").count() == 400
    assert len(a) == 2000


def test_exact_auc_matches_brute_force(spark):
    rows = [(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8), (0, 0.8), (1, 0.9)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = ml.roc_auc(df).first()["roc_auc"]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(got - brute) < 1e-12


def test_exact_auc_over_many_ranges_and_ties(spark):
    rows = [(int((i * 7919) % 11 < 3 + i % 5), float((i * 31) % 97) / 97 if i % 3 else float(i % 4)) for i in range(3000)]
    got = ml.roc_auc(spark.createDataFrame(rows, "label int, score double")).first()["roc_auc"]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(got - brute) < 1e-12
    one_class = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double")
    assert ml.roc_auc(one_class).first()["roc_auc"] is None


def test_auc_has_no_list_of_edges(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("int").alias("label"), F.col("id").cast("double").alias("score"))
    plan = ml.roc_auc(df)._jdf.queryExecution().toString()
    assert "filter(array(" not in plan.lower() and "lambda" not in plan.lower()


def test_flat_forest_equals_the_pipeline(spark):
    """Every row of another table too, rows on thresholds and far outside included."""
    feats = _separable(spark)
    path = tempfile.mkdtemp(prefix="mw-flat-")
    ml.save_model(ml.train_fixed(feats, num_trees=30, max_depth=12), path)
    model, flat = ml.load_model(path), load_forest(spark, path)
    edges = flat.arrays.value
    on = edges.threshold[np.isfinite(edges.threshold)][:200] / edges.scale[0] + edges.mean[0]
    odd = [(i, float(t), 1.0, 100.0, 60.0, 1.6) for i, t in enumerate(on)] + [(900, 1e9, -1e9, 0.0, -5.0, 1e300), (901, 0.0, 0.0, 0.0, None, None)]
    other = spark.createDataFrame(odd, "event_id long, temperature double, vibration double, pressure double, "
                                  "temp_vib_ratio double, pressure_temp_ratio double")
    for rows in (feats, other):
        cols = ["event_id", "prediction", "anomaly_probability", "confidence"]
        want = sorted(map(tuple, ml.score(model, rows).select(cols).collect()))
        assert sorted(map(tuple, ml.score(flat, rows).select(cols).collect())) == want and len(want) == rows.count()


def test_flat_forest_refuses_what_cannot_be_scored(spark):
    path = tempfile.mkdtemp(prefix="mw-flat-")
    feats = _separable(spark, 200)
    ml.save_model(ml.train_fixed(feats, num_trees=2, max_depth=2), path)
    flat = load_forest(spark, path)
    with pytest.raises(Exception, match="has no value"):
        ml.score(flat, feats.withColumn("temperature", F.lit(None).cast("double"))).collect()
    assert ml.score(flat, feats.filter("false")).count() == 0


def test_the_registered_grid_search_runs(spark, monkeypatch):
    """The query itself with Spark's own search, on a smaller grid."""
    from functools import partial

    from machinewatch.plans.registry import queries

    grid = {"n_estimators": (2, 4), "max_depth": (3, None), "min_samples_split": (2,)}
    monkeypatch.setattr(ml, "grid_search", partial(ml.grid_search, **grid, folds=2))
    for name, values in (("GRID_N_ESTIMATORS", (2, 4)), ("GRID_MAX_DEPTH", (3, None)), ("GRID_MIN_SAMPLES_SPLIT", (2,))):
        monkeypatch.setattr(ml, name, values)
    rows = queries()["grid_search"](spark, "/root/testdata/sf0.001").collect()
    assert sorted((r["num_trees"], r["max_depth"], r["min_instances"]) for r in rows) == [(2, 3, 2), (2, 30, 2), (4, 3, 2), (4, 30, 2)]
    assert all(r["auc_above_chance"] and r["refitted"] and r["train_rows"] > 700 for r in rows)


def test_a_forest_is_fitted_by_all_cores(spark, monkeypatch):
    """Rows that come as one partition, as a small file does, are dealt over the cores and keep their places in the trees."""
    from pyspark.ml import Pipeline

    feats, seen, fit = _separable(spark, 300).coalesce(1), {}, Pipeline.fit

    def probe(self, rows, params=None):
        seen.update(parts=rows.rdd.getNumPartitions(), rows=rows.count(), kept=self.getStages()[-1].getCacheNodeIds())
        return fit(self, rows, params)

    monkeypatch.setattr(Pipeline, "fit", probe)
    model = ml.train_fixed(feats, num_trees=2, max_depth=3)
    assert seen == {"parts": spark.sparkContext.defaultParallelism, "rows": 300, "kept": True}
    assert len(model.stages[-1].trees) == 2
    monkeypatch.setattr(ml, "FOREST_ROWS", 10)
    assert ml.spread(feats).rdd.getNumPartitions() == 30 and ml.spread(feats.filter("false")).count() == 0


def test_model_queries_compute_their_rows_once(spark, monkeypatch):
    """What is fitted, scored and compared is read from a stored table; no pass goes back to the events."""
    from functools import partial

    from machinewatch.plans.registry import queries

    read, fit = {}, partial(ml.train_fixed, num_trees=2, max_depth=3)

    def probe(rows, **_):
        read[name] = rows.inputFiles()
        return fit(rows)

    monkeypatch.setattr(ml, "train_fixed", probe)
    monkeypatch.setattr(ml, "grid_search", lambda rows: (probe(rows), {"numTrees": 2, "maxDepth": 3}, [0.6] * 27))
    for name in ("flat_forest", "model_roundtrip", "train_fixed", "grid_search"):
        assert queries()[name](spark, "/root/testdata/sf0.001").count() > 0
        assert read[name] and not [f for f in read[name] if "/root/testdata" in f], name


def test_the_split_is_computed_by_all_cores(spark, monkeypatch):
    """``training_run`` (stream_score, batch_score) deals its rows before they are split, not after."""
    parts, split = [], ml.stratified_split

    def probe(rows, *args, **kwargs):
        parts.append(rows.rdd.getNumPartitions())
        return split(rows, *args, **kwargs)

    monkeypatch.setattr(ml, "stratified_split", probe)
    ml.training_run(_separable(spark, 300).coalesce(1), tempfile.mkdtemp(prefix="mw-model-"), fixed={"num_trees": 2, "max_depth": 3})
    assert parts == [spark.sparkContext.defaultParallelism]
