"""Trees fitted by Spark's ML library, exported so that a scan can score candidates where it finds them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Trees:
    """Binary trees over dense features as arrays by node: ``feature`` -1 marks a leaf, whose ``value`` counts."""

    feature: list[np.ndarray]
    threshold: list[np.ndarray]
    left: list[np.ndarray]
    value: list[np.ndarray]
    weights: np.ndarray
    boosted: bool

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, threshold, left, value, weight in zip(self.feature, self.threshold, self.left, self.value, self.weights):
            at = np.zeros(len(x), np.int64)
            while len(x):
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] > threshold[at]
                at = np.where(inner, left[at] + right, at)
            total += weight * value[at]
        return 1 / (1 + np.exp(-2 * total)) if self.boosted else total / max(self.weights.sum(), 1e-12)


def _export(tree, boosted: bool) -> tuple[np.ndarray, ...]:
    """Nodes breadth first, so that the children of a node stand side by side."""
    queue, feature, threshold, left, value = [tree._call_java("rootNode")], [], [], [], []
    for node in queue:  # grows while it is walked
        inner = node.subtreeDepth() > 0
        stats = node.impurityStats().stats()
        value.append(node.prediction() if boosted else float(stats[1]) / max(sum(map(float, stats)), 1e-12))
        feature.append(node.split().featureIndex() if inner else -1)
        threshold.append(float(node.split().threshold()) if inner else 0.0)
        left.append(len(queue) if inner else 0)
        if inner:
            queue += [node.leftChild(), node.rightChild()]
    return np.array(feature), np.array(threshold), np.array(left), np.array(value, float)


def _fitted(model, boosted: bool) -> Trees:
    parts = list(zip(*(_export(tree, boosted) for tree in model.trees)))
    return Trees(*map(list, parts), np.array([float(w) for w in model.treeWeights]), boosted)


def _ready(rows: DataFrame) -> DataFrame:
    return rows.select(array_to_vector("x").alias("features"), F.col("label").cast("double").alias("label"))


def random_forest(rows: DataFrame, trees: int = 24, depth: int = 6, seed: int = 7) -> Trees:
    """A forest fitted on ``rows`` (x: array<double>, label: 0 or 1)."""
    return _fitted(RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=2).fit(_ready(rows)), False)


def boosted_trees(rows: DataFrame, rounds: int = 16, depth: int = 3, seed: int = 7) -> Trees:
    """Gradient-boosted trees fitted on ``rows`` (x: array<double>, label: 0 or 1)."""
    return _fitted(GBTClassifier(maxIter=rounds, maxDepth=depth, seed=seed).fit(_ready(rows)), True)


def constant(p: float) -> Trees:
    """A model without features, for training rows of one class or none."""
    one = np.array([-1]), np.array([0.0]), np.array([0]), np.array([p])
    return Trees(*([a] for a in one), np.array([1.0]), False)


def both_classes(rows: DataFrame) -> bool:
    return rows.agg(F.countDistinct("label")).first()[0] == 2
