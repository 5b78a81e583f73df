"""Tree models as column arithmetic: a fitted forest as flat arrays, walked by SQL expressions inside the scan.

All nodes of all trees lie in five arrays. A walk starts at a tree's root and takes as many steps as the deepest tree has levels; a
leaf points to itself, so every tree takes the same steps. No row leaves the JVM, and the expression has the size of the arrays, not of
a branch for each node.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from callmart.session import new_path

MEAN, LOGISTIC, SUM = "mean", "logistic", "sum"


@dataclass(frozen=True)
class Forest:
    """Nodes by number: go ``left`` if the feature's value is at most the threshold, else ``right``; a leaf leads to itself.

    ``link`` makes a score of the trees' weighted values: their ``mean``, their ``sum``, or ``logistic`` of their sum.
    """

    features: Sequence[str]
    feature: Sequence[int]
    threshold: Sequence[float]
    left: Sequence[int]
    right: Sequence[int]
    value: Sequence[float]
    roots: Sequence[int]
    weights: Sequence[float]
    link: str = MEAN

    @property
    def depth(self) -> int:
        """Steps to the deepest leaf."""
        level, deepest = list(self.roots), 0
        while level := [n for at in level for n in (self.left[at], self.right[at]) if n != at]:
            deepest += 1
        return deepest

    def column(self) -> Column:
        """The score of a row that has the features. A missing or NaN value goes right."""
        x = F.array(*[F.col(f).cast("double") for f in self.features])
        feature, left, right = (F.array(*map(F.lit, c)) for c in (self.feature, self.left, self.right))
        threshold, value, weights = (F.array(*[F.lit(float(v)) for v in c]) for c in (self.threshold, self.value, self.weights))
        roots = F.array(*map(F.lit, self.roots))

        def step(at: Column, _: Column) -> Column:
            return F.when(F.get(x, F.get(feature, at)) <= F.get(threshold, at), F.get(left, at)).otherwise(F.get(right, at))

        def leaf(root: Column) -> Column:
            return F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), root, step) if self.depth else root

        parts = F.zip_with(roots, weights, lambda root, weight: F.get(value, leaf(root)) * weight)
        total = F.aggregate(parts, F.lit(0.0), lambda sum_, part: sum_ + part)
        if self.link == MEAN:
            return total / F.lit(float(sum(self.weights)))
        return total if self.link == SUM else F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def forest(features: Sequence[str], trees: Sequence[Any], weights: Sequence[float] | None = None, link: str = MEAN) -> Forest:
    """A forest from nested trees: a number is a leaf's value, ``(feature, threshold, left, right)`` a node."""
    columns: dict[str, list] = {c: [] for c in ("feature", "threshold", "left", "right", "value")}
    names = {f: i for i, f in enumerate(features)}

    def add(node: Any) -> int:
        at = len(columns["value"])
        leaf = not isinstance(node, tuple)
        for c, v in (("feature", 0), ("threshold", 0.0), ("left", at), ("right", at), ("value", float(node) if leaf else 0.0)):
            columns[c].append(v)
        if not leaf:
            columns["feature"][at] = names[node[0]]
            columns["threshold"][at] = float(node[1])
            columns["left"][at] = add(node[2])
            columns["right"][at] = add(node[3])
        return at

    roots = [add(tree) for tree in trees]
    return Forest(features=list(features), roots=roots, weights=list(weights or [1.0] * len(roots)), link=link, **columns)


def from_spark(spark: SparkSession, model: Any, features: Sequence[str]) -> Forest:
    """The forest of a fitted Spark ML tree model (decision tree, random forest, gradient-boosted trees) on continuous ``features``.

    The trees are read from the model as it saves itself: a table of nodes. For a classifier the score is
    the probability of class 1, else the prediction.
    """
    path = new_path(spark, "model")
    model.write().save(path)
    nodes: Mapping[int, dict[int, Any]] = {}
    saved = spark.read.parquet(f"{path}/data")
    if "nodeData" in saved.columns:
        saved = saved.select("treeID", "nodeData.*")
    else:
        saved = saved.withColumn("treeID", F.lit(0))
    for row in saved.collect():
        nodes.setdefault(row["treeID"], {})[row["id"]] = row
    classes = hasattr(model, "numClasses")
    boosted = type(model).__name__.startswith("GBT")

    def nested(tree: dict[int, Any], number: int) -> Any:
        row = tree[number]
        if row["leftChild"] < 0:
            if classes and not boosted:
                stats = row["impurityStats"]
                return stats[1] / sum(stats)
            return row["prediction"]
        split = row["split"]
        if split["numCategories"] >= 0:
            raise ValueError("a categorical split has no threshold")
        return (features[split["featureIndex"]], split["leftCategoriesOrThreshold"][0], nested(tree, row["leftChild"]), nested(tree, row["rightChild"]))

    trees = [nested(nodes[t], 0) for t in sorted(nodes)]
    if boosted:
        # Spark's margin is twice the weighted sum.
        scale = 2.0 if classes else 1.0
        return forest(features, trees, [scale * w for w in model.treeWeights], LOGISTIC if classes else SUM)
    return forest(features, trees)
