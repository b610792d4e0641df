"""Smaller forests inside a larger one: fewer trees, less depth, one training.

A forest's first n trees are a forest of n trees. A tree is grown from the
root down and no split depends on what lies below it, so a tree cut at a
depth is a tree grown to that depth; Spark then merges leaves of one parent
that predict the same class, from the bottom up, and so does the cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retention.session import stored_path


class CutForest:
    """A forest's nodes as arrays, as the model's own saved table gives them."""

    def __init__(self, tree, left, right, feature, threshold, prediction, stats):
        self.root = np.flatnonzero(np.append(True, tree[1:] != tree[:-1]))
        offset = np.repeat(self.root, np.diff(np.append(self.root, len(tree))))
        leaf = left < 0
        self.left, self.right = (np.where(leaf, np.arange(len(tree)), x + offset) for x in (left, right))
        self.feature, self.threshold, self.prediction = feature, threshold, prediction
        #: class shares of the training rows in each node
        total = stats.sum(axis=1, keepdims=True)
        self.share = np.divide(stats, total, out=np.zeros_like(stats), where=total != 0)
        self.inner = ~leaf
        self.depth = np.zeros(len(tree), dtype=np.int64)
        level = self.root
        while len(level):
            level = level[self.inner[level]]
            below = np.concatenate([self.left[level], self.right[level]])
            self.depth[below] = np.tile(self.depth[level] + 1, 2)
            level = below

    @classmethod
    def of(cls, model: RandomForestClassificationModel, spark: SparkSession) -> CutForest:
        """The nodes are as large as the model, which the driver and every scoring task hold anyway."""
        path = stored_path(spark, "forest-nodes")
        model.write().save(path)
        node = F.col("nodeData")
        rows = spark.read.parquet(f"{path}/data").select(
            "treeID", node["id"].alias("id"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
            node["prediction"].alias("prediction"), node["impurityStats"].alias("stats"), node["split"]["featureIndex"].alias("feature"),
            node["split"]["numCategories"].alias("categories"), F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold")).toArrow()
        col = {n: np.asarray(rows.column(n).combine_chunks()) for n in rows.column_names if n != "stats"}
        if (col["categories"] > 2).any():
            raise ValueError("splits by more than two categories are not supported")
        # of two categories: 0 lies to the left of 1/2, and where 1 goes left the children change places
        two = col["categories"] >= 0
        swap = two & (col["threshold"] == 1.0)
        col["left"], col["right"] = np.where(swap, col["right"], col["left"]), np.where(swap, col["left"], col["right"])
        col["threshold"] = np.where(two, 0.5, col["threshold"])
        stats = np.array(rows.column("stats").to_pylist(), dtype=float)
        order = np.lexsort((col["id"], col["treeID"]))
        return cls(*(col[n][order] for n in ("treeID", "left", "right", "feature", "threshold", "prediction")), stats[order])

    def leaves(self, depth: int) -> np.ndarray:
        """Which nodes end their tree when it is cut at ``depth``."""
        leaf = ~self.inner | (self.depth >= depth)
        for level in range(min(depth, int(self.depth.max(initial=0))) - 1, -1, -1):
            at = np.flatnonzero((self.depth == level) & ~leaf)
            a, b = self.left[at], self.right[at]
            leaf[at[leaf[a] & leaf[b] & (self.prediction[a] == self.prediction[b])]] = True
        return leaf

    def votes(self, x: np.ndarray, depth: int) -> np.ndarray:
        """(row, tree, class) shares of the leaf that each row reaches."""
        leaf = self.leaves(depth)
        at = np.tile(self.root, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(depth):
            go = ~leaf[at]
            if not go.any():
                break
            left = x[rows, np.where(go, self.feature[at], 0)] <= self.threshold[at]
            at = np.where(go, np.where(left, self.left[at], self.right[at]), at)
        return self.share[at]

    def probabilities(self, x: np.ndarray, trees: list[int], depth: int) -> dict[int, np.ndarray]:
        """Class probabilities of each row by the first n trees, cut at ``depth``, for each n."""
        total = np.cumsum(self.votes(x, depth), axis=1)
        return {n: total[:, n - 1] / total[:, n - 1].sum(axis=1, keepdims=True) for n in trees}

    def accuracies(self, scored: DataFrame, trees: list[int], depths: list[int], rows_at_once: int = 256) -> dict[tuple[int, int], float]:
        """(trees, depth) -> accuracy over ``features`` and ``label``, all settings in one pass."""
        settings = [(n, d) for d in depths for n in trees]
        shared = scored.sparkSession.sparkContext.broadcast(self)

        def run(batches):
            hits, n_rows = np.zeros(len(settings), dtype=np.int64), 0
            for b in batches:
                label = np.asarray(b.column("label"))
                x = np.array(b.column("x").to_pylist(), dtype=float).reshape(len(label), -1)
                for i in range(0, len(label), rows_at_once):
                    part = slice(i, i + rows_at_once)
                    p = {(n, d): v for d in depths for n, v in shared.value.probabilities(x[part], trees, d).items()}
                    hits += [int((p[s].argmax(axis=1) == label[part]).sum()) for s in settings]
                n_rows += len(label)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(settings)), pa.int32()), pa.array(hits), pa.array([n_rows] * len(settings), pa.int64())],
                                             names=["setting", "hits", "n"])

        rows = (scored.select("label", vector_to_array("features").alias("x")).mapInArrow(run, "setting int, hits long, n long")
                .groupBy("setting").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect())
        return {settings[r["setting"]]: r["hits"] / r["n"] if r["n"] else 0.0 for r in rows}
