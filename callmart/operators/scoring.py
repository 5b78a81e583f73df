"""Applying a model, ranking its scores and shaping the result."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmart.context import RunContext
from callmart.fixed_values import SCORE_COLUMNS
from callmart.operators import selection
from callmart.operators.dedupe import top_per
from callmart.operators.ordered import row_index
from callmart.session import stage

Predict = Callable[[pd.DataFrame], Any]


def assemble(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """The model's features in its own order, after the columns to keep."""
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"features missing from the table: {', '.join(missing)}")
    return df.select(*keep, *[f for f in features if f not in keep])


def logistic(weights: Mapping[str, float], intercept: float = 0.0) -> Column:
    """A logistic score as a plain column expression."""
    z = F.lit(float(intercept))
    for name, weight in weights.items():
        z = z + F.col(name).cast("double") * F.lit(float(weight))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def score(
    df: DataFrame,
    scorer: Any,
    features: list[str],
    out: str = "score",
) -> DataFrame:
    """Add a score column.

    ``scorer`` is a Column, a fitted Spark ML model (its probability of class 1, else its
    prediction), or a function without arguments that loads a model and returns its predict
    function. The loader runs once per task, and predict gets batches with only the features.
    """
    if isinstance(scorer, Column):
        return df.withColumn(out, scorer)
    if hasattr(scorer, "transform"):
        from pyspark.ml.functions import vector_to_array

        done = scorer.transform(df)
        if "probability" in done.columns:
            value = vector_to_array("probability")[1]
        else:
            value = F.col("prediction")
        return done.select(*df.columns, value.cast("double").alias(out))

    load: Callable[[], Predict] = scorer

    @F.pandas_udf("double")
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield pd.Series(model(batch[features]), dtype="float64")

    return df.withColumn(out, predict(F.struct(*features)))


def score_segments(
    df: DataFrame, segments: Mapping[str, tuple[Column, Any, list[str]]], keep: list[str]
) -> DataFrame:
    """Score each segment with its own model; a row appears once per segment it belongs to."""
    parts = None
    for name, (predicate, scorer, features) in segments.items():
        rows = score(df.where(predicate), scorer, features)
        rows = rows.select(F.lit(name).alias("segment"), *keep, "score")
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def score_bands(
    df: DataFrame,
    by: str = "score",
    tie: list[str] | None = None,
    bands: int = 10,
    segment: list[str] | None = None,
    out: str = "band",
) -> DataFrame:
    """Equal-size bands by descending score, band 1 on top; ties break by the tie columns.

    Row r of n gets ``ceil(bands * r / n)``, in integer arithmetic. The rows that end the bands are found by counting ranges
    over the rows, which are written once so that the score is worked out once; nothing is sorted or shuffled. Bands
    inside segments, and rows whose ties are not unique, are ranked by a global sort.
    """
    if tie and not segment:
        df = stage(df, "ranked")
        found = selection.bands(df, by, tie, bands, out)
        if found is not None:
            return found
    order = [F.col(by).desc(), *[F.col(c).asc() for c in tie or []]]
    indexed = row_index(df, order, segment)
    top = F.expr(f"({int(bands)}L * row_index + row_total - 1) div row_total")
    return indexed.withColumn(out, top.cast("int")).drop("row_index", "row_total")


def top_scores(df: DataFrame, n: int, by: str = "score", tie: list[str] | None = None) -> DataFrame:
    """The best ``n`` rows."""
    return df.orderBy(F.col(by).desc(), *[F.col(c).asc() for c in tie or []]).limit(n)


def best_per_client(df: DataFrame, key: str, n: int, by: str = "score", tie: list[str] | None = None) -> DataFrame:
    """The best ``n`` phones of each client."""
    return top_per(df, [key], [F.col(by).desc(), *[F.col(c).asc() for c in tie or []]], n)


def export_chunks(df: DataFrame, order: list[Column], size: int, key: str) -> DataFrame:
    """How the rows split into consecutive slices: size and key range of each slice."""
    indexed = row_index(df, order)
    chunk = F.expr(f"(row_index - 1) div {int(size)}").alias("chunk_no")
    return indexed.groupBy(chunk).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key")
    )


def stamp_run(df: DataFrame, ctx: RunContext) -> DataFrame:
    """Add the run's date and time in the three formats a score row carries."""
    return df.select(
        "*",
        F.date_format(ctx.now, "dd.MM.yyyy").alias("DATE_"),
        F.date_format(ctx.now, "yyyyMMdd").cast("int").alias("SK_DATE_SCORE"),
        F.date_format(ctx.now, "dd.MM.yyyy HH:mm:ss").alias("SK_DTIME_SCORE"),
    )


def shape_output(df: DataFrame, names: Mapping[str, str], spec: Mapping[str, str] = SCORE_COLUMNS) -> DataFrame:
    """Rename by ``names``, then fix the column list, order and types."""
    renamed = df.withColumnsRenamed(dict(names))
    return renamed.select(*[F.col(c).cast(t).alias(c) for c, t in spec.items()])
