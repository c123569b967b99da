"""A random forest fitted on counts of cells (M3-M5): the work on rows ends with one aggregate.

Trees split a feature at one of at most ``maxBins - 1`` borders, as Spark's own do, so rows that lie between the
same borders in every feature (a cell) are parted by no tree. One pass over all rows counts the rows of each cell and
class; the counts are bounded by the borders, not by the rows. Spark then deals the trees over the tasks. A tree draws
a cell's n rows as Poisson(n), the sum of n draws of Poisson(1), which is the bootstrap of those rows, and grows layer
by layer (numpy over the cells). Its draws follow from the seed, its number and the layer alone: the forest does not
depend on how rows are dealt, 50 trees are the first of 100, and a tree of depth 10 is one of depth 30 cut there.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator as SparkCrossValidator
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from machinewatch.session import scratch_path

#: Nodes of a layer whose counts are held at once.
BLOCK = 2048
#: A split must lower the impurity by more than what rounding makes of none.
LEAST_GAIN = 1e-12
#: Trees of one task of the grid search, at most.
TASK_TREES = 10

NODES = ("tree int, id int, prediction double, impurity double, stats array<double>, rows bigint, gain double, "
         "left int, right int, feature int, threshold array<double>")


# ---------------------------------------------------------------------------
# Rows -> counts of cells
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Cells:
    """Occupied cells: the borders of each feature (bin b holds ``borders[b - 1] <= x < borders[b]``), the cells' bins,
    and their rows per class, those fitted on and those held out."""

    borders: tuple[np.ndarray, ...]
    bins: np.ndarray  # features x cells
    counts: np.ndarray  # classes x cells
    held: np.ndarray  # classes x cells


def find_borders(rows: DataFrame, columns: list[str], bins: int) -> tuple[np.ndarray, ...]:
    """Borders of at most ``bins`` bins per column: between all values if there are so few, else quantiles of all rows."""
    shares = [k / bins for k in range(1, bins)]
    seen = rows.agg(*[f(F.col(c)).alias(f"{name}_{c}") for c in columns for name, f in (
        ("low", F.min), ("about", F.approx_count_distinct), ("at", lambda x: F.percentile_approx(x, shares)))]).first()
    if seen[f"low_{columns[0]}"] is None:
        raise ValueError("no rows to fit a forest on")
    # A list of values is asked for only where it is short.
    few = [c for c in columns if seen[f"about_{c}"] <= 2 * bins]
    values = rows.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in few]).first().asDict() if few else {}
    out = []
    for c in columns:
        own = np.array(values.get(c, ()), dtype=float)
        if 0 < len(own) <= bins:
            found = np.maximum((own[:-1] + own[1:]) / 2, np.nextafter(own[:-1], np.inf))
        else:
            at, times = np.unique(np.array(seen[f"at_{c}"], dtype=float), return_counts=True)
            # A value that fills a bin is parted from what follows it, too.
            found = np.union1d(at, np.nextafter(at[times > 1], np.inf))
            found = found[found > seen[f"low_{c}"]]
        out.append(found)
    return tuple(out)


def count_cells(rows: DataFrame, features: str, label: str, bins: int, held: str | None = None) -> Cells:
    """The cells of ``rows``, their borders found on the rows that are not ``held`` out."""
    size = rows.schema[features].metadata.get("ml_attr", {}).get("num_attrs") or len(rows.select(features).first()[0])
    columns = [f"x{i}" for i in range(size)]
    apart = F.col(held) if held else F.lit(False)
    flat = rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), apart.alias("held")).select(
        *[F.col("x")[i].alias(c) for i, c in enumerate(columns)], "y", "held")
    borders = find_borders(flat.filter(~F.col("held")), columns, bins)
    split = [c for c, b in zip(columns, borders, strict=True) if len(b)]
    if split:
        flat = Bucketizer(splitsArray=[[-np.inf, *b.tolist(), np.inf] for b in borders if len(b)], inputCols=split,
                          outputCols=[f"b{c}" for c in split]).transform(flat)
    places = [(F.col(f"b{c}") if c in split else F.lit(0)).cast("int").alias(c) for c in columns]
    sides = [((F.col("y") == y) & (F.col("held") == h)) for h in (False, True) for y in (0, 1)]
    # One row per cell: bounded by the borders, not by the rows.
    table = flat.select(*places, "y", "held").groupBy(*columns).agg(
        *[F.count_if(side).alias(f"n{i}") for i, side in enumerate(sides)], F.count(F.lit(1)).alias("n")).toPandas()
    table = table.sort_values(columns, ignore_index=True)
    counts = table[[f"n{i}" for i in range(4)]].to_numpy(dtype=np.int64).T
    if (counts.sum(axis=0) != table["n"].to_numpy()).any():
        raise ValueError("a label is neither 0 nor 1")
    return Cells(borders, table[columns].to_numpy(dtype=np.int16).T.copy(), counts[:2].copy(), counts[2:].copy())


# ---------------------------------------------------------------------------
# Counts -> trees
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Tree:
    """Nodes in the order of their layers; the right child stands behind the left one, a node without children has -1."""

    stats: np.ndarray  # nodes x classes, rows drawn
    feature: np.ndarray
    bin: np.ndarray  # rows of this bin or a lower one go left
    gain: np.ndarray
    left: np.ndarray
    layer: np.ndarray

    def cut(self, depth: int) -> np.ndarray:
        """Per node, the node that stands for it in the tree of at most ``depth`` layers below the root.

        As in Spark's forest, leaves of one parent that predict the same class are merged, from below.
        """
        inner = (self.left >= 0) & (self.layer < depth)
        choice = self.stats.argmax(axis=1)
        layers = [np.flatnonzero((self.layer == d) & inner) for d in range(self.layer.max() + 1)]
        for nodes in reversed(layers):
            a = self.left[nodes]
            inner[nodes[~inner[a] & ~inner[a + 1] & (choice[a] == choice[a + 1])]] = False
        top = np.arange(len(self.left))
        for d in range(self.layer.max() + 1):
            nodes = np.flatnonzero((self.layer == d) & (self.left >= 0))
            for child in (self.left[nodes], self.left[nodes] + 1):
                top[child] = np.where(inner[nodes] & (top[nodes] == nodes), child, top[nodes])
        return top

    def walk(self, bins: np.ndarray) -> np.ndarray:
        """The last node of each cell."""
        at = np.zeros(bins.shape[1], dtype=np.int64)
        moving = np.arange(bins.shape[1])
        while True:
            moving = moving[self.left[at[moving]] >= 0]
            if not len(moving):
                return at
            node = at[moving]
            at[moving] = self.left[node] + (bins[self.feature[node], moving] > self.bin[node])


def _best_splits(bins, drawn, place, totals, allowed, width, least):
    """Feature, bin, gain and left rows of the best split of each of some nodes; ``place`` numbers the cells' nodes."""
    n, features = len(totals), len(bins)
    left = np.empty((2, n, features, width))
    for f in range(features):
        at = place * width + bins[f]
        for c in (0, 1):
            left[c, :, f] = np.bincount(at, drawn[c], n * width).reshape(n, width).cumsum(axis=1)
    right = totals.T[:, :, None, None] - left
    lower, upper = left.sum(axis=0), right.sum(axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        purity = (left ** 2).sum(axis=0) / lower + (right ** 2).sum(axis=0) / upper
    purity[(lower < least) | (upper < least) | ~allowed[:, :, None]] = -np.inf
    best = purity.reshape(n, -1).argmax(axis=1)
    own, feature, at = np.arange(n), best // width, best % width
    rows = totals.sum(axis=1)
    gain = purity[own, feature, at] / rows - (totals ** 2).sum(axis=1) / rows ** 2
    return feature, at, gain, left[:, own, feature, at].T


def grow(cells: Cells, tree: int, seed: int, max_depth: int, min_instances: int, subset: int, bins: int) -> Tree:
    """One tree: Poisson bootstrap, per node ``subset`` features drawn, Gini impurity."""
    rng = np.random.default_rng([seed & (2 ** 64 - 1), tree])
    weights = rng.poisson(cells.counts)
    if not weights.any():  # a handful of rows, none of them drawn
        weights = cells.counts
    live = np.flatnonzero(weights.sum(axis=0))
    x, drawn, place = cells.bins[:, live].astype(np.int64), weights[:, live].astype(float), np.zeros(len(live), dtype=np.int64)
    least = max(min_instances, 1)
    stats = [drawn.sum(axis=1)[None, :]]
    parts: list[tuple[np.ndarray, ...]] = []  # feature, bin, gain, left of each layer
    layers, made, depth = [0], 1, 0
    open_nodes = np.zeros(1, dtype=np.int64)  # within their layer
    while True:
        totals, size = stats[-1], len(stats[-1])
        feature, at, gain, child = (np.full(size, v) for v in (-1, -1, -1.0, -1))
        # Pure nodes and those too small to be split stay leaves.
        may = (totals[open_nodes].min(axis=1) > 0) & (totals[open_nodes].sum(axis=1) >= 2 * least)
        number = np.cumsum(may) - 1
        keep = may[place]
        x, drawn, place, open_nodes = x[:, keep], drawn[:, keep], number[place[keep]], open_nodes[may]
        if depth == max_depth or not len(open_nodes):
            parts.append((feature, at, gain, child))
            break
        chance = rng.random((len(open_nodes), len(x)))
        allowed = chance.argsort(axis=1).argsort(axis=1) < subset
        if len(open_nodes) > BLOCK:
            order = place.argsort(kind="stable")
            x, drawn, place = x[:, order], drawn[:, order], place[order]
        found = []
        for first in range(0, len(open_nodes), BLOCK):
            some = open_nodes[first:first + BLOCK]
            a, b = (0, len(place)) if len(open_nodes) <= BLOCK else np.searchsorted(place, (first, first + len(some)))
            found.append(_best_splits(x[:, a:b], drawn[:, a:b], place[a:b] - first, totals[some], allowed[first:first + len(some)],
                                      bins, least))
        best, split_at, lowered, lower = (np.concatenate(c) for c in zip(*found, strict=True))
        splits = lowered > LEAST_GAIN
        nodes = open_nodes[splits]
        feature[nodes], at[nodes], gain[nodes] = best[splits], split_at[splits], lowered[splits]
        child[nodes] = made + 2 * np.arange(len(nodes))
        parts.append((feature, at, gain, child))
        if not len(nodes):
            break
        # The children, left and right in turn, are the next layer.
        stats.append(np.stack([lower[splits], totals[nodes] - lower[splits]], axis=1).reshape(-1, 2))
        keep = splits[place]
        x, drawn, place = x[:, keep], drawn[:, keep], place[keep]
        right = x[best[place], np.arange(len(place))] > split_at[place]
        place = 2 * (np.cumsum(splits) - 1)[place] + right
        open_nodes = np.arange(2 * len(nodes))
        made, depth = made + 2 * len(nodes), depth + 1
        layers.append(depth)
    feature, at, gain, child = (np.concatenate(c) for c in zip(*parts, strict=True))
    return Tree(np.concatenate(stats), feature, at, gain, child, np.repeat(layers, [len(s) for s in stats]))


def tree_nodes(tree: Tree, number: int, max_depth: int, borders: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    """The cut tree's nodes as rows of ``NODES``."""
    top = tree.cut(max_depth)
    kept = np.flatnonzero(top == np.arange(len(top)))
    ids = np.cumsum(top == np.arange(len(top))) - 1
    child = tree.left[kept]
    inner = (child >= 0) & (top[child] == child)
    stats = tree.stats[kept]
    rows = stats.sum(axis=1)
    # A border belongs to the upper bin: what goes left is at most the number before it.
    threshold = [[float(np.nextafter(borders[f][b], -np.inf))] if i else [] for f, b, i in
                 zip(tree.feature[kept], tree.bin[kept], inner, strict=True)]
    return pa.RecordBatch.from_pydict({
        "tree": pa.array(np.full(len(kept), number), pa.int32()), "id": pa.array(np.arange(len(kept)), pa.int32()),
        "prediction": stats.argmax(axis=1).astype(float), "impurity": 1 - (stats ** 2).sum(axis=1) / rows ** 2,
        "stats": pa.array(list(stats), pa.list_(pa.float64())), "rows": rows.astype(np.int64), "gain": np.where(inner, tree.gain[kept], -1.0),
        "left": pa.array(np.where(inner, ids[child], -1), pa.int32()), "right": pa.array(np.where(inner, ids[child + 1 - (child < 0)], -1), pa.int32()),
        "feature": pa.array(np.where(inner, tree.feature[kept], -1), pa.int32()), "threshold": pa.array(threshold, pa.list_(pa.float64()))})


# ---------------------------------------------------------------------------
# Estimators
# ---------------------------------------------------------------------------
class CellForestClassifier(RandomForestClassifier):
    """Spark's random forest with the same parameters and the same kind of model, fitted on counts of cells.

    Two classes, Gini impurity, the square root of the features per node and a bootstrap of all rows.
    """

    def subset(self, features: int) -> int:
        return features if self.getNumTrees() == 1 else int(np.ceil(np.sqrt(features)))

    def check(self) -> None:
        """A parameter that this fit would ignore is refused."""
        own = {"featuresCol", "labelCol", "predictionCol", "probabilityCol", "rawPredictionCol", "numTrees", "maxDepth", "maxBins",
               "minInstancesPerNode", "seed", "cacheNodeIds", "checkpointInterval", "maxMemoryInMB"}
        if other := {p.name for p in self._paramMap} - own:
            raise ValueError(f"not fitted on counts of cells: {sorted(other)}")

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        self.check()
        spark = dataset.sparkSession
        cells = count_cells(dataset, self.getFeaturesCol(), self.getLabelCol(), self.getMaxBins())
        path = scratch_path(spark, f"forest-{uuid.uuid4().hex}")
        held = spark.sparkContext.broadcast(cells)
        args = (self.getSeed(), self.getMaxDepth(), self.getMinInstancesPerNode(), self.subset(len(cells.bins)), self.getMaxBins())

        def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number in batch.column(0).to_pylist():
                    yield tree_nodes(grow(held.value, number, *args), number, args[1], held.value.borders)

        trees, cores = self.getNumTrees(), spark.sparkContext.defaultParallelism
        nodes = spark.range(0, trees, 1, min(trees, 2 * cores)).mapInArrow(plant, NODES)
        split = F.struct(F.col("feature").alias("featureIndex"), F.col("threshold").alias("leftCategoriesOrThreshold"),
                         F.lit(-1).alias("numCategories"))
        nodes.select(F.col("tree").alias("treeID"), F.struct(
            "id", "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("rows").alias("rawCount"), "gain",
            F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split")).alias("nodeData")
        ).write.parquet(os.path.join(path, "data"))
        held.unpersist()
        self._write_metadata(spark, path, len(cells.bins))
        return RandomForestClassificationModel.load(path)

    def _write_metadata(self, spark, path: str, features: int) -> None:
        """The descriptions that Spark's saved forest has beside its nodes."""
        tree_params = DecisionTreeClassifier()

        def described(name: str, uid: str, keep=lambda p: True, **more) -> str:
            maps = {key: {p.name: v for p, v in values.items() if keep(p.name)} for key, values in (
                ("paramMap", self._paramMap), ("defaultParamMap", self._defaultParamMap))}
            return json.dumps({"class": f"org.apache.spark.ml.classification.{name}", "timestamp": int(time.time() * 1000),
                               "sparkVersion": spark.version, "uid": uid, **maps, **more})

        trees = [(i, described("DecisionTreeClassificationModel", f"dtc_{uuid.uuid4().hex[:12]}", tree_params.hasParam), 1.0)
                 for i in range(self.getNumTrees())]
        spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(os.path.join(path, "treesMetadata"))
        whole = described("RandomForestClassificationModel", self.uid, numFeatures=features, numClasses=2, numTrees=self.getNumTrees())
        spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(os.path.join(path, "metadata"))


def weighted_auc(score: np.ndarray, counts: np.ndarray) -> float:
    """ROC AUC of cells with ``counts`` rows per class: ties count half; 0 if a class is absent."""
    values, at = np.unique(score, return_inverse=True)
    neg, pos = (np.bincount(at, c, len(values)) for c in counts)
    below = np.cumsum(neg) - neg
    pairs = pos.sum() * neg.sum()
    return float((pos * (below + neg / 2)).sum() / pairs) if pairs else 0.0


class CrossValidator(SparkCrossValidator):
    """Spark's search for a pipeline that ends with a ``CellForestClassifier``, scored by ROC AUC.

    Every grid point is fitted and scored on all rows of every fold. A fold's rows are counted once; a tree that
    several points share (its number and split size, to any depth) is grown once, and the rows of a held-out cell, which
    every tree gives the same score, are scored once. The scores equal those of the points fitted one by one.
    """

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        estimator, grid = self.getEstimator(), self.getEstimatorParamMaps()
        if self.getEvaluator().getMetricName() != "areaUnderROC":
            raise ValueError("the search is scored by areaUnderROC")
        stages = estimator.getStages()
        points = [stages[-1].copy({p: v for p, v in point.items() if stages[-1].hasParam(p.name)}) for point in grid]
        forest = points[0]
        forest.check()
        spark, folds = dataset.sparkSession, []
        for train, validation in self._kFold(dataset):
            both = train.withColumn("_held", F.lit(False)).unionByName(validation.withColumn("_held", F.lit(True)))
            ready = Pipeline(stages=stages[:-1]).fit(train).transform(both)
            folds.append(count_cells(ready, forest.getFeaturesCol(), forest.getLabelCol(), forest.getMaxBins(), "_held"))
        scores = self._scores(spark, folds, points)
        metrics = [[scores[i, p.getMinInstancesPerNode(), p.getMaxDepth(), p.getNumTrees()] for p in points] for i in range(len(folds))]
        means, stds = np.mean(metrics, axis=0).tolist(), np.std(metrics, axis=0).tolist()
        best = estimator.fit(dataset, grid[int(np.argmax(means))])
        return self._copyValues(CrossValidatorModel(best, means, None, stds))

    @staticmethod
    def _scores(spark, folds: list[Cells], points: list[CellForestClassifier]) -> dict:
        """AUC by (fold, split size, depth, trees)."""
        held = spark.sparkContext.broadcast(folds)
        forest, features = points[0], len(folds[0].bins)
        seed, bins = forest.getSeed(), forest.getMaxBins()
        depths = sorted({p.getMaxDepth() for p in points})
        sizes = sorted({p.getNumTrees() for p in points})
        # Trees are dealt in runs that no size of a forest cuts; one tree alone sees all features, so it is another tree.
        runs = [(several, first, min(first + TASK_TREES, b)) for several in (False, True)
                for own in ([n for n in sizes if (n > 1) == several],) for a, b in zip([0, *own], own)
                for first in range(a, b, TASK_TREES)]
        work = [(i, least, several, a, b) for several, a, b in runs for i in range(len(folds))
                for least in sorted({p.getMinInstancesPerNode() for p in points})]
        subset = {several: max(points, key=lambda p: (p.getNumTrees() > 1) == several).subset(features) for several in (False, True)}

        def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for fold, least, several, first, last in (work[i] for i in batch["id"]):
                    cells = held.value[fold]
                    asked = np.flatnonzero(cells.held.sum(axis=0))
                    votes = {d: np.zeros(len(asked)) for d in depths}
                    for number in range(first, last):
                        tree = grow(cells, number, seed, depths[-1], least, subset[several], bins)
                        at, share = tree.walk(cells.bins[:, asked]), tree.stats[:, 1] / tree.stats.sum(axis=1)
                        for d in depths:
                            votes[d] += share[tree.cut(d)[at]]
                    yield pd.DataFrame([(fold, least, d, several, last, votes[d]) for d in depths],
                                       columns=["fold", "least", "depth", "several", "last", "votes"])

        def rank(part: pd.DataFrame) -> pd.DataFrame:
            cells = held.value[part["fold"].iloc[0]]
            counts = cells.held[:, np.flatnonzero(cells.held.sum(axis=0))]
            votes, out = np.zeros(counts.shape[1]), []
            for row in part.sort_values("last").itertuples():
                votes += row.votes
                if row.last in sizes:
                    # Equal scores stay equal, whatever order their trees were added in.
                    out.append((row.fold, row.least, row.depth, row.last, weighted_auc(np.round(votes / row.last, 12), counts)))
            return pd.DataFrame(out, columns=["fold", "least", "depth", "trees", "auc"])

        tasks = spark.range(0, len(work), 1, min(len(work), 8 * spark.sparkContext.defaultParallelism))
        voted = tasks.mapInPandas(vote, "fold int, least int, depth int, several boolean, last int, votes array<double>")
        ranked = voted.groupBy("fold", "least", "depth", "several").applyInPandas(
            rank, "fold int, least int, depth int, trees int, auc double").collect()
        held.unpersist()
        return {(r["fold"], r["least"], r["depth"], r["trees"]): r["auc"] for r in ranked}
