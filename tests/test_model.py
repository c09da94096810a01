"""Training, evaluation, the gate, reload and scoring."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from roompulse.functions.rules import comfort_label
from roompulse.functions.scoring import LinearModel, with_score
from roompulse.operators.comfort_model import (
    Report, assembler, complete_and_rejected, evaluate, linear_model, load, save_if_good, score, train,
)
from roompulse.operators.evaluation import accuracy, area_under_roc, confusion_counts


def labelled(spark, n=2000):
    rows = spark.range(n).select(
        (F.rand(1) * 100).alias("light"), (F.rand(2) * 50).alias("temperature"),
        (F.rand(3) * 100).alias("humidity"), "id",
    )
    turned = F.col("id") % 17 == 0
    return rows.withColumn("comfortable", F.when(turned, 1 - comfort_label()).otherwise(comfort_label()))


def fitted(spark):
    return train(labelled(spark))


@pytest.fixture(scope="module")
def model(spark):
    return fitted(spark)


def test_column_scores_equal_the_models(spark, model):
    rows = labelled(spark)
    by_model = score(rows, model).select("id", "prediction", vector_to_array("probability")[1].alias("p"))
    by_column = with_score(rows, linear_model(model)).select(
        "id", F.col("prediction").alias("prediction2"), F.col("probability").alias("p2")
    )
    both = by_model.join(by_column, "id")
    assert both.filter("prediction <> prediction2 OR abs(p - p2) > 1e-9").count() == 0
    assert both.count() == 2000


def test_feature_order_is_kept_and_checked(spark, model, tmp_path):
    assert model.stages[0].getInputCols() == ["light", "temperature", "humidity"]
    path = str(tmp_path / "model")
    assert save_if_good(model, Report(0.9, 0.9, None), path)
    reloaded = load(path)
    rows = labelled(spark)
    same = score(rows, model).select("id", "prediction").exceptAll(
        score(rows, reloaded).select("id", "prediction")
    )
    assert same.count() == 0
    with pytest.raises(ValueError, match="saved model"):
        load(path, ["temperature", "humidity", "light"])
    with pytest.raises(ValueError, match="features"):
        LinearModel.from_fitted(model.stages[-1], ["light"])


def test_the_gate(spark, model, tmp_path):
    assert not save_if_good(model, Report(0.5, 0.9, None), str(tmp_path / "no"))
    assert not (tmp_path / "no").exists()
    assert save_if_good(model, Report(0.51, 0.1, None), str(tmp_path / "yes"))


def test_report(spark, model):
    report = evaluate(score(labelled(spark), model))
    counts = {(r["label"], r["prediction"]): r["count"] for r in report.confusion.collect()}
    assert sum(counts.values()) == 2000
    assert report.accuracy == pytest.approx((counts[(0.0, 0.0)] + counts[(1.0, 1.0)]) / 2000)
    assert 0.5 < report.auc <= 1


def test_area_under_roc_with_ties(spark):
    rows = [(1.0, 0.9), (0.0, 0.9), (1.0, 0.4), (0.0, 0.1), (1.0, 0.1), (1.0, 0.8)]
    df = spark.createDataFrame(rows, "label double, score double")
    pairs = [(p, n) for is_p, p in rows for is_n, n in rows if is_p == 1.0 and is_n == 0.0]
    expected = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    assert area_under_roc(df, score="score", bins=0) == pytest.approx(expected)


def test_confusion_and_accuracy(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 0.0), (0, 0.0), (0, None)], "label int, prediction double")
    assert {tuple(r) for r in confusion_counts(df).collect()} == {
        (1, 1.0, 1), (1, 0.0, 1), (0, 0.0, 1), (0, None, 1)
    }
    assert accuracy(confusion_counts(df)) == 0.5


def test_incomplete_rows_are_set_apart(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, 1.0), (None, 1.0, 1.0), (1.0, 1.0, None)], "light double, temperature double, humidity double"
    )
    complete, rejected = complete_and_rejected(df)
    assert (complete.count(), rejected.count()) == (1, 2)
    assert assembler().transform(complete).first()["features"].size == 3
    with pytest.raises(Exception, match="(?i)null"):
        assembler().transform(df).collect()


def test_a_bare_model_needs_the_order_of_its_features(spark, tmp_path):
    from roompulse.operators.comfort_model import train

    order = ["temperature", "humidity", "light"]
    rows = spark.createDataFrame(
        [(float(i % 30), float(i % 53), float(i * 7 % 900), int(i % 30 > 17)) for i in range(300)], "temperature double, humidity double, light double, comfortable int")
    model = train(rows, features=order)
    model.stages[-1].write().save(f"{tmp_path}/bare")
    with pytest.raises(ValueError, match="order"):
        load(f"{tmp_path}/bare")
    with pytest.raises(ValueError):
        load(f"{tmp_path}/bare", order[:2])
    again = load(f"{tmp_path}/bare", order)
    values = [tuple(r) for r in score(rows, model).select("light", "probability", "prediction").collect()]
    assert [tuple(r) for r in score(rows, again).select("light", "probability", "prediction").collect()] == values


def test_strict_scoring_stops_with_plain_weights_too(spark):
    from roompulse.plans.batch import FIXED_MODEL
    from roompulse.streaming.scoring import score_readings

    schema = "mac string, rssi int, temperature double, humidity double, light double, timestamp timestamp"
    whole = spark.createDataFrame([("a", 1, 20.0, 40.0, 900.0, None)], schema)
    assert score_readings(whole, FIXED_MODEL, strict=True).count() == 1
    for bad in (None, float("nan")):
        broken = spark.createDataFrame([("a", 1, 20.0, 40.0, bad, None)], schema)
        with pytest.raises(Exception, match="lacks a feature"):
            score_readings(broken, FIXED_MODEL, strict=True).collect()
        assert score_readings(broken, FIXED_MODEL).count() == 1
