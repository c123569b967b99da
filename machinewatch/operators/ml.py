"""Anomaly classifier with Spark ML.

Training, scoring and evaluation are distributed: the feature pipeline and
the forest run on executors, metrics are aggregates, and only bounded
results (one metrics row, per-bucket counts) reach the driver.
"""

from __future__ import annotations

import json
import math
import os
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from machinewatch.operators.forest import FlatForest
from machinewatch.operators.ranges import in_ranges, running_offsets
from machinewatch.operators.trees import CellForestClassifier, CrossValidator
from machinewatch.schema import (
    CV_FOLDS,
    FIXED_MAX_DEPTH,
    FIXED_N_ESTIMATORS,
    GRID_MAX_DEPTH,
    GRID_MIN_SAMPLES_SPLIT,
    GRID_N_ESTIMATORS,
    MODEL_FEATURES,
    PLAUSIBLE_RANGES,
    SEED,
    TEST_FRACTION,
)
from machinewatch.session import scratch_path

SPARK_MAX_DEPTH = 30  # Spark's cap; stands in for "unlimited depth"
#: Rows of a task that fits or walks a forest, at most; fewer rows go to one task per core.
FOREST_ROWS = 500_000
#: Steps of a sensor's plausible range within which rows count as alike.
NEAR_STEPS = 40


# ---------------------------------------------------------------------------
# M2: deterministic stratified split
# ---------------------------------------------------------------------------
def split_hash(id_col: str = "event_id", seed: int = SEED) -> Column:
    """Per-row sort key: md5 of ``'<seed>-<id>'`` (identical in any engine, any partitioning)."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string")))


def _prefix_value(h: Column) -> Column:
    """First 15 hex digits of the hash as a 60-bit integer (order-preserving)."""
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def stratified_split(df: DataFrame, label: str = "label", id_col: str = "event_id",
                     test_fraction: float = TEST_FRACTION, seed: int = SEED,
                     bits_per_round: int = 12) -> DataFrame:
    """Adds ``split`` = 'test' for the ``ceil(test_fraction * n_class)`` rows of each class
    with the smallest hash key, else 'train'.

    Exact and distributed: instead of ranking every row of a class in one
    task, the k-th smallest key per class is found by radix refinement --
    each round counts rows per (class, next 12 bits of the key) among the
    rows still in play (at most 4096 counts per class reach the driver)
    and narrows to the bucket that holds the k-th row. Five rounds cover
    the 60-bit prefix; remaining exact ties fall back to the full hash.
    """
    keyed = df.withColumn("_h", split_hash(id_col, seed)).withColumn("_p", _prefix_value(F.col("_h")))
    # The refinement rounds only need (class, key): persist that narrow
    # projection once instead of re-reading the input each round.
    keys = keyed.select(label, "_h", "_p").persist(StorageLevel.MEMORY_AND_DISK)
    total_bits = 60
    sizes = {r[0]: r[1] for r in keys.groupBy(label).count().collect()}
    # Per class: (value of the fixed high bits, number of fixed bits, rows still to take).
    active = {c: (0, 0, int(math.ceil(test_fraction * n))) for c, n in sizes.items()}
    active = {c: st for c, st in active.items() if st[2] > 0}
    done: dict = {}
    while active:
        in_play, bucket, plan = F.lit(False), F.lit(None).cast("bigint"), {}
        for c, (value, fixed, _) in active.items():
            width = min(bits_per_round, total_bits - fixed)
            shift = total_bits - fixed - width
            cond = F.col(label) == F.lit(c)
            if fixed:
                cond = cond & (F.shiftright(F.col("_p"), total_bits - fixed) == F.lit(value))
            in_play = in_play | cond
            bucket = F.when(cond, F.shiftright(F.col("_p"), shift).bitwiseAND(F.lit((1 << width) - 1))
                            ).otherwise(bucket)
            plan[c] = width
        counts: dict = {}
        for row in keys.filter(in_play).groupBy(label, bucket.alias("_b")).count().collect():
            counts.setdefault(row[0], []).append((row[1], row[2]))
        nxt = {}
        for c, (value, fixed, remaining) in active.items():
            acc = 0
            for b, n in sorted(counts.get(c, [])):
                if acc + n >= remaining:
                    value, fixed, remaining = (value << plan[c]) | b, fixed + plan[c], remaining - acc
                    break
                acc += n
            (done if fixed >= total_bits else nxt)[c] = (value, fixed, remaining)
        active = nxt
    # Test rows: key prefix below the class threshold, plus ``remaining`` rows
    # at the threshold prefix taken in full-hash order (an exact-tie set).
    test_cond = F.lit(False)
    for c, (value, _, remaining) in done.items():
        is_c = F.col(label) == F.lit(c)
        test_cond = test_cond | (is_c & (F.col("_p") < F.lit(value)))
        at = is_c & (F.col("_p") == F.lit(value))
        # The k-th hash of the tied rows, from counts per distinct hash: one row per
        # distinct hash with this 60-bit prefix, however often an id repeats.
        last, seen = None, 0
        for row in keys.filter(at).groupBy("_h").count().orderBy("_h").toLocalIterator():
            last, seen = row["_h"], seen + row["count"]
            if seen >= remaining:
                break
        test_cond = test_cond | (at & (F.col("_h") <= F.lit(last)))
    keys.unpersist()
    return keyed.withColumn("split", F.when(test_cond, F.lit("test")).otherwise(F.lit("train"))).drop("_h", "_p")


# ---------------------------------------------------------------------------
# M1, M3-M5: pipeline and training
# ---------------------------------------------------------------------------
def assembler() -> VectorAssembler:
    """Strict on purpose: a row that cannot be scored must have been rejected before, not vanish here."""
    return VectorAssembler(inputCols=list(MODEL_FEATURES), outputCol="features", handleInvalid="error")


def model_input(df: DataFrame) -> DataFrame:
    """A ratio without a value (zero denominator) enters the model as 0, so every row is scored."""
    ratios = ("temp_vib_ratio", "pressure_temp_ratio")
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in ratios})


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over all cores: a forest costs far more per row than its bytes tell, and a small file is one task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // FOREST_ROWS)))


def alike(df: DataFrame) -> DataFrame:
    """The rows of each partition with like sensors behind one another: they walk the same nodes, which then lie in the cache."""
    if df.isStreaming:
        return df
    # Vibration, which most trees split first, leads.
    sensors = ("vibration", "temperature", "pressure")
    steps = {c: (high - low) / NEAR_STEPS for c, (low, high) in PLAUSIBLE_RANGES.items()}
    return df.sortWithinPartitions(*[F.floor(F.col(c) / F.lit(steps[c])) for c in sensors], *sensors)


def rf_pipeline(num_trees: int = FIXED_N_ESTIMATORS, max_depth: int | None = FIXED_MAX_DEPTH,
                min_instances: int = 1, seed: int = SEED) -> Pipeline:
    """M3: assemble -> standardize (mean and std) -> random forest, grown on counts of cells.

    Each cell's node is kept from layer to layer: no layer walks the trees from their roots.
    """
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    rf = CellForestClassifier(featuresCol="scaled", labelCol="label", numTrees=num_trees,
                              maxDepth=min(max_depth or SPARK_MAX_DEPTH, SPARK_MAX_DEPTH),
                              minInstancesPerNode=min_instances, seed=seed, cacheNodeIds=True)
    return Pipeline(stages=[assembler(), scaler, rf])


def train_fixed(train: DataFrame, **params) -> PipelineModel:
    """M5: fixed parameters (100 trees, depth 20), fitted by all cores on rows that are computed once."""
    rows = spread(model_input(train)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return rf_pipeline(**params).fit(rows)
    finally:
        rows.unpersist()


def grid_search(train: DataFrame, n_estimators=GRID_N_ESTIMATORS, max_depth=GRID_MAX_DEPTH,
                min_samples_split=GRID_MIN_SAMPLES_SPLIT, folds: int = CV_FOLDS,
                parallelism: int = 4, seed: int = SEED, max_rows: int | None = None,
                id_col: str = "event_id"):
    """M4: grid over trees x depth x split size, k-fold CV scored by ROC AUC, on all rows.

    ``min_samples_split`` maps to Spark's nearest knob ``minInstancesPerNode``
    (minimum rows per child, a stricter rule); ``None`` depth maps to 30.
    A caller may bound the search (not the model) to about ``max_rows`` rows,
    those whose id hash is lowest. The model returned is fitted on
    all of ``train`` with the best parameters.
    Returns (best PipelineModel, best params dict, mean AUC per grid point).
    """
    pipe = rf_pipeline(seed=seed)
    rf = pipe.getStages()[-1]
    grid = (ParamGridBuilder()
            .addGrid(rf.numTrees, list(n_estimators))
            .addGrid(rf.maxDepth, [min(d or SPARK_MAX_DEPTH, SPARK_MAX_DEPTH) for d in max_depth])
            .addGrid(rf.minInstancesPerNode, list(min_samples_split))
            .build())
    evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction",
                                              metricName="areaUnderROC")
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
                        parallelism=parallelism, seed=seed)
    rows = model_input(train)
    if max_rows is not None:
        share = max_rows / max(train.count(), 1)
        rows = rows.filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < F.lit(share * (1 << 30)))
    rows = spread(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cv_model = cv.fit(rows)
    finally:
        rows.unpersist()
    best_idx = max(range(len(grid)), key=lambda i: cv_model.avgMetrics[i])
    best = {p.name: v for p, v in grid[best_idx].items()}
    # A search over all rows has fitted its best point on all of them.
    model = cv_model.bestModel if max_rows is None else train_fixed(
        train, num_trees=best["numTrees"], max_depth=best["maxDepth"], min_instances=best["minInstancesPerNode"], seed=seed)
    return model, best, list(cv_model.avgMetrics)


# ---------------------------------------------------------------------------
# Scoring and prediction records
# ---------------------------------------------------------------------------
def score(model: PipelineModel | FlatForest, df: DataFrame) -> DataFrame:
    """Class, probability of anomaly and confidence (max class probability)."""
    if isinstance(model, FlatForest):
        return model.score(alike(model_input(df)))
    # A model fitted in this session keeps its training summary, and with it the
    # session; a copy does not, so it can always be sent to executors.
    out = model.copy().transform(alike(model_input(df)))
    probs = vector_to_array(F.col("probability"))
    return out.withColumns({
        "prediction": F.col("prediction").cast("int"),
        "anomaly_probability": probs[1],
        "confidence": F.array_max(probs),
    }).drop("features", "scaled", "rawPrediction", "probability")


def postprocess_prediction(df: DataFrame, pred: str = "prediction") -> DataFrame:
    """Label and severity of a prediction."""
    is_anomaly = F.col(pred) == 1
    return df.withColumns({
        "prediction_label": F.when(is_anomaly, F.lit("anomaly")).otherwise(F.lit("normal")),
        "severity": F.when(is_anomaly, F.lit("high")).otherwise(F.lit("normal")),
    })


# ---------------------------------------------------------------------------
# M6-M9: evaluation as aggregates
# ---------------------------------------------------------------------------
def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """M9: (label, prediction, count) cells."""
    return df.groupBy(F.col(label).cast("int").alias("label"),
                      F.col(pred).cast("int").alias("prediction")).agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """M9 as a 2x2 table: one row per true class, predicted classes as columns."""
    cells = confusion_counts(df, label, pred)
    return cells.groupBy("label").pivot("prediction", [0, 1]).agg(F.first("count")).select(
        "label", F.coalesce(F.col("0"), F.lit(0)).cast("bigint").alias("predicted_0"),
        F.coalesce(F.col("1"), F.lit(0)).cast("bigint").alias("predicted_1"))


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """M6: share of correct predictions."""
    return df.agg((F.count_if(F.col(label).cast("int") == F.col(pred).cast("int")).cast("double")
                   / F.count(F.lit(1)).cast("double")).alias("accuracy"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """M8: precision, recall, f1, support per class plus macro and weighted averages."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    # One scan: the counts of both classes in one row, the rest on that row.
    counts = df.agg(*[F.count_if(cond).alias(f"{name}_{c}") for c in (0, 1) for name, cond in (
        ("tp", (y == c) & (p == c)), ("fp", (y != c) & (p == c)), ("fn", (y == c) & (p != c)))])
    per = counts.select(F.inline(F.array(*[F.struct(
        F.lit(str(c)).alias("class"), *[F.col(f"{n}_{c}").alias(n) for n in ("tp", "fp", "fn")]) for c in (0, 1)])))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    per = per.withColumns({"precision": prec, "recall": rec,
                           "support": (F.col("tp") + F.col("fn")).cast("bigint")})
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))).otherwise(0.0))
    per = per.select("class", "precision", "recall", "f1", "support")
    total = F.sum("support").cast("double")
    measures = ("precision", "recall", "f1")
    both = per.agg(F.collect_list(F.struct("class", *measures, "support")).alias("per"),
                   F.struct(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures],
                            F.sum("support").alias("support")).alias("macro"),
                   F.struct(F.lit("weighted avg").alias("class"),
                            *[(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in measures],
                            F.sum("support").alias("support")).alias("weighted"))
    return both.select(F.inline(F.concat("per", F.array("macro", "weighted"))))


def roc_auc(df: DataFrame, label: str = "label", score_col: str = "score") -> DataFrame:
    """M7: exact ROC AUC by rank sum with mid-ranks for tied scores.

    AUC = sum over distinct scores s of pos(s) * (neg(<s) + neg(s)/2) / (P*N).
    ``neg(<s)`` is a prefix sum over the distinct scores, which are written in
    ranges of their order: one row per range gives each its offset, and a
    running sum within the range does the rest. A tied score is one row, so
    no tie crosses a border.
    """
    y = F.col(label).cast("int")
    per_score = df.groupBy(F.col(score_col).cast("double").alias("s")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    ranged = in_ranges(per_score, [F.col("s")], scratch_path(df.sparkSession, f"auc-{uuid.uuid4().hex}"))
    within = Window.partitionBy("part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    offsets = F.broadcast(running_offsets(ranged, F.col("neg")))
    ranked = ranged.withColumn("inside", F.coalesce(F.sum("neg").over(within), F.lit(0))).join(offsets, "part").withColumn(
        "neg_below", F.col("offset") + F.col("inside"))
    return ranked.agg(
        (F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
         / F.nullif(F.sum("pos").cast("double") * F.sum("neg").cast("double"), F.lit(0.0))).alias("roc_auc"))


# ---------------------------------------------------------------------------
# S21, S22, M12
# ---------------------------------------------------------------------------
def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def evaluate(model: PipelineModel, test: DataFrame) -> dict:
    """Accuracy, exact AUC and the classification report of ``model`` on ``test``."""
    scored = score(model, test).withColumn("label", F.col("label").cast("int")).cache()
    acc = accuracy(scored).first()["accuracy"]
    auc = roc_auc(scored, score_col="anomaly_probability").first()["roc_auc"]
    report = {r["class"]: {"precision": r["precision"], "recall": r["recall"], "f1-score": r["f1"],
                           "support": r["support"]} for r in classification_report(scored).collect()}
    cells = {(r["label"], r["prediction"]): r["count"] for r in confusion_counts(scored).collect()}
    scored.unpersist()
    return {"accuracy": acc, "roc_auc": auc, "classification_report": report,
            "confusion_matrix": [[cells.get((a, b), 0) for b in (0, 1)] for a in (0, 1)]}


def training_run(features: DataFrame, out_dir: str, use_grid: bool = False, fixed: dict | None = None,
                 **grid_args) -> dict:
    """Split -> train (grid or fixed) -> evaluate -> save model and results."""
    split = stratified_split(spread(features)).cache()
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    if use_grid:
        model, best, _ = grid_search(train, **grid_args)
    else:
        fixed = fixed or {"num_trees": FIXED_N_ESTIMATORS, "max_depth": FIXED_MAX_DEPTH}
        model, best = train_fixed(train, **fixed), dict(fixed)
    model_path = os.path.join(out_dir, "model")
    save_model(model, model_path)
    # What is evaluated is the saved model, as it will be used.
    metrics = evaluate(load_model(model_path), test)
    results = {"model_path": model_path, "best_params": best, "train_rows": train.count(),
               "test_rows": test.count(), **metrics}
    spark = features.sparkSession
    spark.createDataFrame([(json.dumps(results, default=str),)], "value string") \
        .write.mode("overwrite").text(os.path.join(out_dir, "training_results"))
    split.unpersist()
    return results
