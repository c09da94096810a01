"""Logistic regression as plain column arithmetic, inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LinearModel:
    """Weights by feature name, so a feature order can not be mixed up."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float
    threshold: float = 0.5

    @classmethod
    def from_fitted(cls, model, features: Sequence[str]) -> LinearModel:
        """From a fitted binary logistic regression, with the features it was assembled from."""
        if model.numFeatures != len(features):
            raise ValueError(f"the model has {model.numFeatures} features, not {len(features)}")
        return cls(
            tuple(features),
            tuple(float(w) for w in model.coefficients),
            float(model.intercept),
            float(model.getThreshold()),
        )


def margin(model: LinearModel) -> Column:
    total = F.lit(model.intercept)
    for name, weight in zip(model.features, model.weights, strict=True):
        total = total + F.col(name) * F.lit(weight)
    return total


def with_score(df: DataFrame, model: LinearModel) -> DataFrame:
    """Add ``probability`` of class 1 and ``prediction``; a NULL or NaN feature gives NULL for both."""
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(model)))
    scored = df.withColumn("probability", F.nanvl(probability, F.lit(None).cast("double")))
    return scored.withColumn(
        "prediction",
        F.when(F.col("probability") > model.threshold, 1.0).when(F.col("probability").isNotNull(), 0.0),
    )
