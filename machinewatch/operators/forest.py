"""A saved forest as flat arrays (M10, ST2): no model object is rebuilt or sent again for each batch.

The trees of a saved ``PipelineModel`` are one table of nodes; here it becomes
arrays of feature, threshold, children and class shares, broadcast once when
the model is loaded. A batch of rows walks all trees at the same time, one layer
per step (numpy in a Pandas UDF): every row stands at one node per tree, and a
leaf is its own child. The arithmetic is that of the pipeline, operation by
operation, so predictions and probabilities equal its own.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that walk at once: as many places as this times the trees are held.
BLOCK = 2048


@dataclass(frozen=True)
class Arrays:
    """Standardization and the nodes of all trees; ``roots`` are their first nodes."""

    mean: np.ndarray
    scale: np.ndarray
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Class probabilities of each row: the trees' leaf shares, summed in the trees' order."""
        if np.isnan(rows).any():
            raise ValueError("a feature has no value; such rows are rejected before they are scored")
        out = np.empty((len(rows), self.share.shape[1]))
        for at in range(0, len(rows), BLOCK):
            x = (rows[at:at + BLOCK] - self.mean) * self.scale
            mine, places = np.arange(len(x))[:, None], np.repeat(self.roots[None, :], len(x), axis=0)
            while True:
                below = np.where(x[mine, self.feature[places]] <= self.threshold[places], self.left[places], self.right[places])
                if (below == places).all():
                    break
                places = below
            votes = np.zeros((len(x), self.share.shape[1]))
            for tree in range(len(self.roots)):
                votes += self.share[places[:, tree]]
            out[at:at + BLOCK] = votes / votes.sum(axis=1, keepdims=True)
        return out


@dataclass(frozen=True)
class FlatForest:
    """Arrays of a loaded forest on the executors, and the names of its features."""

    arrays: Broadcast
    features: tuple[str, ...]

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``, ``anomaly_probability`` and ``confidence``."""
        arrays = self.arrays

        def walk(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            for columns in batches:
                p = arrays.value.probabilities(np.column_stack([c.to_numpy(dtype=float) for c in columns]))
                yield pd.DataFrame({"prediction": p.argmax(axis=1).astype(np.int32), "anomaly_probability": p[:, 1],
                                    "confidence": p.max(axis=1)})

        walk.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.DataFrame]}
        udf = F.pandas_udf(walk, "prediction int, anomaly_probability double, confidence double")
        features = [F.col(c).cast("double") for c in self.features]
        return df.select("*", udf(*features).alias("_scored")).select(*df.columns, "_scored.*")


def _metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(os.path.join(path, "metadata")).first()["value"])


def load_forest(spark: SparkSession, path: str) -> FlatForest:
    """The forest of a ``PipelineModel`` (assembler, scaler, forest) saved at ``path``."""
    stages = [os.path.join(path, "stages", f"{i}_{uid}") for i, uid in enumerate(_metadata(spark, path)["paramMap"]["stageUids"])]
    assembler, scaler, forest = stages
    features = tuple(_metadata(spark, assembler)["paramMap"]["inputCols"])
    fitted = spark.read.parquet(os.path.join(scaler, "data")).first()
    mean, std = (np.array(fitted[c].toArray()) for c in ("mean", "std"))

    # One row per node of the model, as large as the model itself.
    node = F.col("nodeData")
    nodes = spark.read.parquet(os.path.join(forest, "data")).select(
        "treeID", node["id"].alias("id"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"), node["split"]["numCategories"].alias("categories"),
        F.try_element_at(node["split"]["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"),
        node["impurityStats"].alias("stats")).toPandas().sort_values(["treeID", "id"], ignore_index=True)
    if (nodes["categories"] >= 0).any():
        raise ValueError("a split on categories has no threshold")
    own = np.arange(len(nodes))
    # Node ids count from 0 within each tree: a tree's nodes stand behind its root.
    sizes = nodes.groupby("treeID").size().to_numpy()
    roots = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    base = np.repeat(roots, sizes)
    if not (nodes["id"].to_numpy() == own - base).all():
        raise ValueError("the nodes of a tree are not numbered without gaps")
    leaf = nodes["left"].to_numpy() < 0
    stats = np.array(nodes["stats"].tolist(), dtype=float)
    arrays = Arrays(
        mean=mean, scale=np.divide(1.0, std, out=np.zeros_like(std), where=std != 0), roots=roots,
        feature=np.where(leaf, 0, nodes["feature"]).astype(np.int32),
        threshold=np.where(leaf, np.inf, nodes["threshold"].to_numpy(dtype=float)),
        left=np.where(leaf, own, base + nodes["left"]), right=np.where(leaf, own, base + nodes["right"]),
        share=stats / stats.sum(axis=1, keepdims=True))
    return FlatForest(spark.sparkContext.broadcast(arrays), features)
