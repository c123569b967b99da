"""The forest on counts of cells: against brute force, Spark's own search, other dealings of the rows."""
import numpy as np
import pytest
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from machinewatch.operators import ml, trees
from test_model import _separable


def _cells(n=300, features=3, bins=6, seed=5):
    rng = np.random.default_rng(seed)
    x = np.unique(rng.integers(0, bins, (n, features)), axis=0).T
    counts = rng.integers(0, 4, (2, x.shape[1]))
    return trees.Cells(tuple(np.arange(1.0, bins) for _ in range(features)), x.astype(np.int16), counts, counts)


def _brute(x, w, depth, least, bins):
    """(class rows, best gain, children) by trying every border of every feature."""
    n = w.sum()
    gini = lambda v: 1 - ((v.sum(axis=1) / v.sum()) ** 2).sum()
    best = (0.0, None)
    if depth and w.sum(axis=1).min() > 0:
        for f in range(len(x)):
            for b in range(bins - 1):
                low = x[f] <= b
                a, c = w[:, low].sum(), w[:, ~low].sum()
                if min(a, c) >= least:
                    gain = gini(w) - a / n * gini(w[:, low]) - c / n * gini(w[:, ~low])
                    if gain > best[0] + 1e-12:
                        best = (gain, (f, b))
    if best[1] is None:
        return w.sum(axis=1).tolist(), -1.0, None
    low = x[best[1][0]] <= best[1][1]
    return w.sum(axis=1).tolist(), best[0], [_brute(x[:, m], w[:, m], depth - 1, least, bins) for m in (low, ~low)]


@pytest.mark.parametrize("least,block", [(1, 2048), (1, 2), (7, 3)])
def test_a_tree_is_the_one_of_brute_force(monkeypatch, least, block):
    monkeypatch.setattr(trees, "BLOCK", block)
    cells = _cells()
    tree = trees.grow(cells, 3, 42, 6, least, 3, 6)
    drawn = np.random.default_rng([42, 3]).poisson(cells.counts)

    def same(node, brute):
        stats, gain, children = brute
        assert tree.stats[node].tolist() == stats and (tree.left[node] >= 0) == (children is not None)
        assert tree.gain[node] == pytest.approx(gain)
        return children is None or all(same(tree.left[node] + i, c) for i, c in enumerate(children))

    live = drawn.sum(axis=0) > 0
    assert same(0, _brute(cells.bins[:, live], drawn[:, live], 6, least, 6)) and tree.layer.max() > 2
    # Where a cell ends is where its rows were counted.
    at = tree.walk(cells.bins)
    for node in np.unique(at):
        assert drawn[:, at == node].sum(axis=1).tolist() == tree.stats[node].tolist() and tree.left[node] == -1


def test_a_shallow_tree_is_a_deep_one_cut():
    cells = _cells()
    deep, flat = (trees.grow(cells, 1, 7, depth, 1, 2, 6) for depth in (30, 3))
    assert deep.layer.max() > 3
    for cut, tree in ((3, deep), (30, flat), (3, flat)):
        nodes = trees.tree_nodes(tree, 0, cut, cells.borders).to_pydict()
        want = trees.tree_nodes(flat, 0, 3, cells.borders).to_pydict()
        assert nodes == want
    # No two leaves of one parent predict the same class, and children stand behind their parents.
    for i, a in enumerate(want["left"]):
        if a >= 0:
            b = want["right"][i]
            assert i < a < b and (want["left"][a] >= 0 or want["left"][b] >= 0 or want["prediction"][a] != want["prediction"][b])


def test_borders_part_all_of_few_values_and_quantiles_of_many(spark):
    rows = spark.range(10_000).select(
        (F.col("id") % 3).cast("double").alias("few"), F.col("id").cast("double").alias("many"), F.lit(4.0).alias("one"),
        F.when(F.col("id") < 7000, 0.0).otherwise(F.col("id") - 9000.0).alias("heavy"))
    few, many, one, heavy = trees.find_borders(rows, ["few", "many", "one", "heavy"], 32)
    assert few.tolist() == [0.5, 1.5] and len(one) == 0 and len(many) == 31
    assert np.abs(many - np.arange(1, 32) * 10_000 / 32).max() < 10
    # A value with most of the rows is parted from those below and above.
    assert 0.0 in heavy and np.nextafter(0.0, 1.0) in heavy and (np.diff(heavy) > 0).all()


def test_a_forest_does_not_depend_on_how_rows_are_dealt(spark):
    feats = _separable(spark, 600)
    one, other = (ml.rf_pipeline(6, 8).fit(ml.model_input(feats.repartition(n))).stages[-1] for n in (1, 7))
    # The scaler sums in another order, so borders may differ in their last digits; counts and shapes do not.
    shape = lambda m: [(t.numNodes, t.depth) for t in m.trees]
    assert shape(one) == shape(other) and len(one.trees) == 6
    more = ml.rf_pipeline(9, 8).fit(ml.model_input(feats)).stages[-1]
    assert shape(more)[:6] == shape(one)


def test_a_fit_passes_over_its_rows_a_few_times(spark):
    """The jobs of a fit do not grow with its depth: no layer of the trees goes back to the rows."""
    feats, jobs = _separable(spark, 1000).persist(), {}
    feats.count()
    for depth in (2, 20):
        spark.sparkContext.setJobGroup(f"fit-{depth}", "")
        ml.train_fixed(feats, num_trees=5, max_depth=depth)
        jobs[depth] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit-{depth}"))
    spark.sparkContext.setJobGroup("", "")
    feats.unpersist()
    assert jobs[20] <= jobs[2] + 2


def test_the_search_equals_its_points_fitted_one_by_one(spark):
    """Spark's own search fits and scores every point apart; the shared one gives the same AUC."""
    rows = ml.model_input(_separable(spark, 800)).withColumn("label", F.when(F.col("event_id") % 7 == 0, 1 - F.col("label")).otherwise(
        F.col("label"))).repartition(2).persist()
    pipe = ml.rf_pipeline()
    rf = pipe.getStages()[-1]
    grid = ParamGridBuilder().addGrid(rf.numTrees, [1, 12]).addGrid(rf.maxDepth, [2, 30]).addGrid(rf.minInstancesPerNode, [1, 9]).build()
    evaluator = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)
    args = {"estimator": pipe, "estimatorParamMaps": grid, "evaluator": evaluator, "numFolds": 2, "seed": 42}
    shared, apart = trees.CrossValidator(**args).fit(rows), CrossValidator(**args).fit(rows)
    assert shared.avgMetrics == pytest.approx(apart.avgMetrics, abs=1e-9) and len(set(shared.avgMetrics)) > 4
    assert shared.bestModel.stages[-1].getNumTrees == apart.bestModel.stages[-1].getNumTrees
    rows.unpersist()


def test_the_grid_search_takes_all_rows(spark, monkeypatch):
    """The search is not fitted on a sample, and the model it returns was fitted on the same rows."""
    seen, count = [], trees.count_cells

    def probe(rows, *args):
        cells = count(rows, *args)
        seen.append((int(cells.counts.sum()), int(cells.held.sum())))
        return cells

    monkeypatch.setattr(trees, "count_cells", probe)
    model, best, aucs = ml.grid_search(_separable(spark, 2500), n_estimators=(2, 4), max_depth=(3, None), min_samples_split=(2,), folds=3)
    assert len(seen) == 4 and all(sum(s) == 2500 for s in seen) and sum(s[1] for s in seen) == 2500
    assert seen[-1] == (2500, 0) and len(model.stages[-1].trees) == best["numTrees"] and len(aucs) == 4 and min(aucs) > 0.9


def test_what_cannot_be_fitted_is_refused(spark):
    feats = ml.model_input(_separable(spark, 60))
    with pytest.raises(ValueError, match="neither 0 nor 1"):
        ml.rf_pipeline(2, 2).fit(feats.withColumn("label", F.col("label") + 1))
    with pytest.raises(ValueError, match="subsamplingRate"):
        trees.CellForestClassifier(featuresCol="f", subsamplingRate=0.5).fit(feats)
    one = ml.rf_pipeline(3, 4).fit(feats.filter("label = 1"))
    assert [t.numNodes for t in one.stages[-1].trees] == [1, 1, 1] and {r["prediction"] for r in ml.score(one, feats).collect()} == {1}


def test_like_rows_are_scored_one_after_another(spark):
    """Rows are ordered within their partitions before they are scored, none is moved or lost."""
    feats = _separable(spark, 400).repartition(3).persist()
    near = ml.alike(feats).select(F.spark_partition_id().alias("part"), "event_id", "vibration")
    at = lambda df: sorted(map(tuple, df.select(F.spark_partition_id(), "event_id").collect()))
    assert at(near) == at(feats)
    rows = near.collect()
    for part in range(3):
        steps = [r["vibration"] // 0.25 for r in rows if r["part"] == part]
        assert steps == sorted(steps)
    plan = ml.score(ml.train_fixed(feats, num_trees=2, max_depth=2), feats)._jdf.queryExecution().executedPlan().toString()
    assert "Sort [FLOOR" in plan.replace("floor", "FLOOR")
    feats.unpersist()
