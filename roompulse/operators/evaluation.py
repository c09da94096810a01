"""How well predictions fit the labels."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion_counts(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per label and prediction; at most four rows leave each task."""
    return scored.groupBy(label, prediction).count()


def area_under_roc(
    scored: DataFrame, label: str = "label", score: str = "rawPrediction", bins: int = 1000
) -> float:
    """Area under the ROC curve; ``bins=0`` uses every distinct score instead of ``bins`` points."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=label, metricName="areaUnderROC", numBins=bins
    )
    return evaluator.evaluate(scored)


def rank_area(scored: DataFrame, label: str = "label", score: str = "score", buckets: int = 64) -> float | None:
    """The share of (positive, negative) pairs that the scores rank rightly, ties counting half: the exact area under ROC.

    Rows are summed per distinct score. Approximate quantiles cut the scores into ranges; how many negatives lie below a range is a
    prefix sum over one row per range, and inside a range a window goes on from there. Rows without a label or score are left out;
    without positives or negatives there is no pair and no area.
    """
    rows = scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
    by_score = rows.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.sum(F.col(label).cast("long")).alias("up"), F.sum(1 - F.col(label).cast("long")).alias("down"))
    shares = [i / buckets for i in range(1, buckets)]
    found = by_score.agg(F.percentile_approx("s", shares, 100 * buckets)).first()[0] if shares else None
    bounds = sorted(set(found or []))
    above = F.filter(F.lit(bounds) if bounds else F.array().cast("array<double>"), lambda bound: bound < F.col("s"))
    ranged = by_score.withColumn("part", F.size(above))
    sums = sorted(ranged.groupBy("part").agg(F.sum("up"), F.sum("down")).collect())
    ups, downs = sum(r[1] for r in sums), sum(r[2] for r in sums)
    if not ups or not downs:
        return None
    bases, base = [], 0
    for part, _, down in sums:
        bases.append((part, base))
        base += down
    first = rows.sparkSession.createDataFrame(bases, "part int, base long")
    below = Window.partitionBy("part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("inside", F.coalesce(F.sum("down").over(below), F.lit(0))).join(F.broadcast(first), "part")
    twice = F.col("up").cast("decimal(19,0)") * (2 * (F.col("base") + F.col("inside")) + F.col("down")).cast("decimal(19,0)")
    return int(placed.agg(F.sum(twice)).first()[0]) / (2 * ups * downs)


def accuracy(confusion: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    """The share of right predictions, from the confusion counts; a missing prediction is wrong."""
    right = F.when(F.col(label) == F.col(prediction), F.col("count")).otherwise(0)
    hits, total = confusion.agg(F.sum(right), F.sum("count")).first()
    return hits / total
