"""Tree models as columns: the same scores as Spark ML gives, and as plain Python gives."""

import math
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from callmart.operators.scoring import score
from callmart.operators.trees import LOGISTIC, SUM, forest, from_spark


@pytest.fixture(scope="module")
def data(spark):
    return spark.range(400).selectExpr(
        "id", "cast(id % 7 as double) as a", "pmod(hash(id), 100) / 10.0 as b", "cast(id % 3 as double) as c",
        "cast(pmod(hash(id), 10) + id % 7 > 8 as double) as label",
    ).cache()


MODELS = [
    (DecisionTreeClassifier, {"maxDepth": 4}),
    (RandomForestClassifier, {"numTrees": 7, "maxDepth": 5, "seed": 1}),
    (GBTClassifier, {"maxIter": 5, "maxDepth": 3, "seed": 1}),
    (RandomForestRegressor, {"numTrees": 5, "maxDepth": 4, "seed": 1}),
    (GBTRegressor, {"maxIter": 4, "maxDepth": 3, "seed": 1}),
]


@pytest.mark.parametrize("kind, settings", MODELS, ids=lambda m: getattr(m, "__name__", ""))
def test_equals_the_fitted_model(spark, data, kind, settings):
    names = ["a", "b", "c"]
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), kind(**settings)]).fit(data)
    flat = from_spark(spark, pipeline.stages[-1], names)
    # The branch of ``score`` that takes a fitted model, and the one that takes a column.
    whole = score(score(data, pipeline, names, "fitted"), flat.column(), names, "walked")
    assert whole.columns == [*data.columns, "fitted", "walked"]
    assert whole.where(F.abs(F.col("fitted") - F.col("walked")) > 1e-9).count() == 0
    assert whole.select("fitted").distinct().count() > 3
    assert "Python" not in score(data, flat.column(), names)._jdf.queryExecution().executedPlan().toString()


def walk(node, row):
    while isinstance(node, tuple):
        value = row[node[0]]
        node = node[2] if value is not None and value <= node[1] else node[3]
    return node


@pytest.mark.parametrize("link", ["mean", SUM, LOGISTIC])
def test_random_trees(spark, link):
    """Trees of any shape, a single leaf among them, and missing values."""
    rnd = random.Random(5)
    grow = lambda depth: rnd.random() if depth == 0 or rnd.random() < 0.2 else (rnd.choice("xyz"), rnd.uniform(-1, 1), grow(depth - 1), grow(depth - 1))
    trees, weights = [grow(5) for _ in range(6)] + [0.25], [rnd.random() for _ in range(7)]
    rows = [tuple(rnd.choice([None, rnd.uniform(-1, 1), 0.0]) for _ in "xyz") for _ in range(60)]
    got = spark.createDataFrame(rows, "x double, y double, z double").withColumn("s", forest("xyz", trees, weights, link).column()).collect()
    for r in got:
        total = sum(w * walk(t, r.asDict()) for t, w in zip(trees, weights, strict=True))
        want = {"mean": total / sum(weights), SUM: total, LOGISTIC: 1 / (1 + math.exp(-total))}[link]
        assert abs(r["s"] - want) < 1e-9


def test_only_leaves(spark):
    assert spark.range(1).select(forest(["id"], [0.5, 1.0]).column().alias("s")).first()[0] == 0.75
