"""The comfort classifier: assemble, fit, evaluate, save behind a gate, load and score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.functions.rules import is_number, prediction_text
from roompulse.functions.scoring import LinearModel
from roompulse.operators.evaluation import accuracy, area_under_roc, confusion_counts
from roompulse.schemas import SENSOR_COLUMNS

# Fixed value: a model is kept when its area under the ROC curve is above this.
QUALITY_GATE = 0.5


@dataclass(frozen=True)
class Report:
    """Measures on the test rows; ``rejected`` counts rows that could be neither trained on nor tested."""

    auc: float
    accuracy: float
    confusion: DataFrame
    rejected: int = 0


def assembler(features: list[str] | None = None) -> VectorAssembler:
    return VectorAssembler(inputCols=features or SENSOR_COLUMNS, outputCol="features")


def train(labelled: DataFrame, label: str = "comfortable", features: list[str] | None = None) -> PipelineModel:
    """Fit on labelled readings. Assembler and model stay together, so the feature order does too."""
    features = features or SENSOR_COLUMNS
    rows = labelled.select(*features, F.col(label).cast("double").alias("label"))
    regression = LogisticRegression(featuresCol="features", labelCol="label")
    return Pipeline(stages=[assembler(features), regression]).fit(rows)


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds ``features``, ``rawPrediction``, ``probability`` and ``prediction``. A NULL feature fails."""
    return model.transform(df)


def evaluate(scored: DataFrame, label: str = "comfortable", bins: int = 0) -> Report:
    """Exact area under the curve; ``bins`` above 0 allow an approximation. Two passes over the scored rows: the confusion counts, a handful of rows, and the ROC curve."""
    rows = scored.select(F.col(label).cast("double").alias("label"), "rawPrediction", "prediction")
    counts = confusion_counts(rows)
    confusion = scored.sparkSession.createDataFrame(counts.collect(), counts.schema)
    return Report(area_under_roc(rows, bins=bins), accuracy(confusion), confusion)


def save_if_good(model: PipelineModel, report: Report, path: str, gate: float = QUALITY_GATE) -> bool:
    """Save the model when it beats the gate; says whether it did."""
    if report.auc <= gate:
        return False
    model.write().overwrite().save(path)
    return True


def load(path: str, features: list[str] | None = None) -> PipelineModel:
    """Load a saved model and check that it takes the expected features in the expected order.

    A folder may also hold a bare logistic regression, which doesn't know the names of its features: their order has to be
    stated then, and an assembler for it is set before the model.
    """
    spark = SparkSession.active()
    if DefaultParamsReader.loadMetadata(path, spark)["class"].endswith(".LogisticRegressionModel"):
        if features is None:
            raise ValueError(f"{path} holds a model alone: state the order of its features")
        model = PipelineModel([assembler(features), LogisticRegressionModel.load(path)])
    else:
        model = PipelineModel.load(path)
    expected = features or SENSOR_COLUMNS
    assembled = model.stages[0].getInputCols()
    if list(assembled) != list(expected) or model.stages[-1].numFeatures != len(expected):
        raise ValueError(f"the saved model takes {model.stages[-1].numFeatures} features {assembled}, not {expected}")
    return model


def linear_model(model: PipelineModel) -> LinearModel:
    """The fitted weights, for scoring as column arithmetic."""
    return LinearModel.from_fitted(model.stages[-1], model.stages[0].getInputCols())


def complete_and_rejected(df: DataFrame, features: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with all features, and the others, which a model can not score."""
    whole = F.lit(True)
    for name in features or SENSOR_COLUMNS:
        whole = whole & is_number(name)
    return df.filter(whole), df.filter(~whole)


def usable_and_rejected(
    df: DataFrame, label: str = "comfortable", features: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows with all features and a label of 0 or 1, and the others."""
    known = F.coalesce(F.col(label).isin(0, 1), F.lit(False))
    complete, incomplete = complete_and_rejected(df, features)
    return complete.filter(known), incomplete.unionByName(complete.filter(~known))


def with_prediction_text(scored: DataFrame) -> DataFrame:
    return scored.withColumn("prediction_str", prediction_text())
