"""Fitted tree ensembles as flat arrays, for one-step predictions inside a task."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class FlatEnsemble:
    """All trees in one node table; children are absolute positions and a leaf is its own child.

    Its size follows from the number and depth of the trees, never from the training rows.
    """

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weights: np.ndarray
    divisor: float
    depth: int

    def predict(self, rows: np.ndarray, chunk: int = 1024) -> np.ndarray:
        """Predictions for a (rows x features) matrix, walking all trees of a chunk in step."""
        parts = [self._predict(rows[i : i + chunk]) for i in range(0, len(rows), chunk)]
        return np.concatenate(parts) if parts else np.empty(0)

    def _predict(self, rows: np.ndarray) -> np.ndarray:
        line = np.arange(len(rows))[:, None]
        node = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
        for _ in range(self.depth):
            goes_left = rows[line, self.feature[node]] <= self.threshold[node]
            node = np.where(goes_left, self.left[node], self.right[node])
        return self.value[node] @ self.weights / self.divisor


def flatten(spark: SparkSession, model, path: str) -> FlatEnsemble:
    """Node table of a fitted forest or boosted ensemble, read from its saved form at ``path``.

    Both kinds save the same layout.  Forest trees are averaged, boosted trees added up by weight.
    """
    model.write().overwrite().save(path)
    nodes = (
        spark.read.parquet(f"{path}/data")
        .select(
            "treeID",
            "nodeData.id",
            "nodeData.prediction",
            "nodeData.leftChild",
            "nodeData.rightChild",
            "nodeData.split.featureIndex",
            "nodeData.split.leftCategoriesOrThreshold",
        )
        .toPandas()
        .sort_values(["treeID", "id"], ignore_index=True)
    )
    sizes = nodes.groupby("treeID").size().to_numpy()
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    offset = np.repeat(starts, sizes)
    here = np.arange(len(nodes))
    leaf = nodes["leftChild"].to_numpy() < 0
    cut = [0.0 if is_leaf else c[0] for is_leaf, c in zip(leaf, nodes["leftCategoriesOrThreshold"])]
    weights = np.asarray(model.treeWeights, dtype=float)
    averaged = type(model).__name__.startswith("RandomForest")
    return FlatEnsemble(
        roots=starts,
        feature=np.where(leaf, 0, nodes["featureIndex"].to_numpy()),
        threshold=np.asarray(cut),
        left=np.where(leaf, here, offset + nodes["leftChild"].to_numpy()),
        right=np.where(leaf, here, offset + nodes["rightChild"].to_numpy()),
        value=nodes["prediction"].to_numpy(dtype=float),
        weights=weights,
        divisor=float(len(weights)) if averaged else 1.0,
        depth=max(int(model._java_obj.trees()[i].depth()) for i in range(len(weights))),
    )
