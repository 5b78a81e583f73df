"""Scoring, bands and export slices."""

from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from callmart.context import RunContext
from callmart.operators.scoring import assemble, export_chunks, logistic, score, score_bands
from callmart.plans.scores import model_rows, segment_output, write_scores
from callmart.fixed_values import DAILY_MODEL_FEATURES, SCORE_COLUMNS

CTX = RunContext(datetime(2024, 1, 31))


@pytest.mark.parametrize("n", [1, 3, 10, 11, 25])
def test_band_edges(spark, n):
    """Band i holds the rows between floor((i-1)·n/10) and floor(i·n/10)."""
    got = score_bands(spark.range(0, n, 1, 3).selectExpr("id", "-id as score"), tie=["id"])
    edges = np.linspace(0, n, 11).astype(int)
    expected = {row: band + 1 for band in range(10) for row in range(edges[band], edges[band + 1])}
    assert {r["id"]: r["band"] for r in got.collect()} == expected


def test_equal_scores_rank_the_same_on_any_partitioning(spark, conf):
    data = spark.range(500).selectExpr("id", "0.5 as score")
    results = []
    for parts in (1, 3, 8):
        conf(spark__sql__shuffle__partitions=str(parts))
        banded = score_bands(data.repartition(parts), tie=["id"])
        results.append(sorted((r["id"], r["band"]) for r in banded.collect()))
    assert results[0] == results[1] == results[2]
    assert results[0][0] == (0, 1) and results[0][-1] == (499, 10)


def test_no_rows(spark):
    assert score_bands(spark.range(0).selectExpr("id", "id as score"), tie=["id"]).count() == 0


def test_chunks_cover_every_row(spark):
    got = export_chunks(spark.range(1, 1001), [F.col("id").asc()], 300, "id").orderBy("chunk_no").collect()
    assert [tuple(r) for r in got] == [(0, 300, 1, 300), (1, 300, 301, 600), (2, 300, 601, 900), (3, 100, 901, 1000)]


def test_missing_features_are_named(spark):
    with pytest.raises(ValueError, match="b, c"):
        assemble(spark.range(1).selectExpr("id", "1 as a"), ["a", "b", "c"], ["id"])


def test_three_kinds_of_scorer_agree(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    data = spark.range(300).selectExpr("id", "id % 7 as a", "id % 5 as b", "cast(pmod(hash(id), 10) + id % 7 > 8 as double) as label").cache()
    stages = [VectorAssembler(inputCols=["a", "b"], outputCol="features"), LogisticRegression(maxIter=5)]
    model = Pipeline(stages=stages).fit(data)
    fitted = model.stages[-1]
    weights = dict(zip(["a", "b"], map(float, fitted.coefficients)))
    bias = float(fitted.intercept)

    def load():
        def predict(batch: pd.DataFrame):
            assert list(batch.columns) == ["a", "b"]
            z = bias + batch["a"] * weights["a"] + batch["b"] * weights["b"]
            return 1 / (1 + np.exp(-z))

        return predict

    kinds = [model, load, logistic(weights, bias)]
    got = [{r["id"]: r["score"] for r in score(data, s, ["a", "b"]).collect()} for s in kinds]
    assert len(got[0]) == 300
    for i in got[0]:
        assert got[0][i] == pytest.approx(got[1][i]) == pytest.approx(got[2][i])


def features(spark, n=40):
    values = ", ".join(f"cast(id % 3 as double) as {c}" for c in DAILY_MODEL_FEATURES)
    return spark.range(n).selectExpr("cast(7010000000 + id as string) as phone_number", "id as cuid", "'1' as x", *[v for v in values.split(", ")])


def test_model_rows_fill_and_filter(spark):
    df = features(spark, 3)
    df = df.withColumn("phone_number", F.expr("case cuid when 0 then '123' when 1 then null else phone_number end"))
    df = df.withColumn("cnt_in_calls_6m", F.lit(None).cast("double")).withColumn("cuid", F.when(F.col("cuid") < 2, F.col("cuid")))
    row = model_rows(df, CTX).collect()
    assert len(row) == 1
    assert (row[0]["cuid"], row[0]["cnt_in_calls_6m"], row[0]["weekday"]) == (-1, 0.0, 3)


def test_scores_replace_their_day(spark, tmp_path):
    path = str(tmp_path / "scores")
    scorer = logistic({"cnt_in_calls_6m": 0.1})
    for n in (40, 25):
        write_scores(features(spark, n), scorer, CTX, path)
    write_scores(features(spark, 10), scorer, RunContext(datetime(2024, 2, 1)), path)
    back = spark.read.parquet(path)
    assert back.columns == [*SCORE_COLUMNS, "part_date"]
    assert {r["part_date"]: r["count"] for r in back.groupBy("part_date").count().collect()} == {20240131: 25, 20240201: 10}


def test_segments_are_banded_apart(spark):
    df = features(spark, 40)
    one = logistic({"cnt_in_calls_6m": 1.0})
    got = segment_output(df, {"all": (F.lit(True), one, []), "few": (F.col("cuid") < 20, one, [])})
    counts = {(r["segment"], r["band"]): r["count"] for r in got.groupBy("segment", "band").count().collect()}
    assert all(counts[("all", b)] == 4 and counts[("few", b)] == 2 for b in range(1, 11))
