"""Labels and buckets on and around their limits."""

import uuid

import pytest

from roompulse.functions.rules import comfort_label, life_stage, prediction_text
from roompulse.functions.scoring import LinearModel, with_score
from roompulse.operators.split import hash_split, in_train


def label(spark, light, temperature, humidity, rule="below"):
    df = spark.createDataFrame(
        [(light, temperature, humidity)], "light double, temperature double, humidity double"
    )
    return df.select(comfort_label(light_rule=rule)).first()[0]


@pytest.mark.parametrize(
    ("reading", "below", "above"),
    [
        ((20.0, 30.0, 60.0), 1, 1),
        ((19.99, 30.0, 60.0), 0, 1),
        ((20.01, 30.0, 60.0), 1, 0),
        ((20.0, 30.01, 60.0), 0, 0),
        ((20.0, 30.0, 60.01), 0, 0),
        ((None, 20.0, 50.0), None, None),
        ((None, 40.0, 50.0), None, None),
        ((float("nan"), 20.0, 50.0), None, None),
        ((float("inf"), 20.0, 50.0), 1, 0),
    ],
)
def test_comfort_label(spark, reading, below, above):
    assert label(spark, *reading) == below
    assert label(spark, *reading, rule="above") == above


def test_unknown_light_rule():
    with pytest.raises(ValueError, match="light_rule"):
        comfort_label(light_rule="sideways")


def test_prediction_text(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (None,), (2.0,)], "prediction double")
    texts = [r[0] for r in df.select(prediction_text()).collect()]
    assert texts == ["comfortable", "not comfortable", "not comfortable", "not comfortable"]


def test_life_stage(spark):
    ages = [12, 13, 19, 20, None]
    df = spark.createDataFrame([(a,) for a in ages], "age long")
    stages = [r[0] for r in df.select(life_stage()).collect()]
    assert stages == ["child", "teenager", "teenager", "adult", "adult"]


def test_life_stage_means(spark):
    from roompulse.sources.tables import literal_rows

    people = literal_rows(
        spark, [("ann", 32), ("ben", 3), ("cy", 75), ("di", 13)], ["first_name", "age"]
    )
    means = people.withColumn("life_stage", life_stage()).groupBy("life_stage").agg({"age": "mean"})
    assert means.columns == ["life_stage", "avg(age)"]
    assert dict(map(tuple, means.collect())) == {"adult": 53.5, "child": 3.0, "teenager": 13.0}


def test_managed_table(spark):
    from roompulse.sinks.batch import write_table
    from roompulse.sources.tables import catalog_table, literal_rows

    name = f"people_{uuid.uuid4().hex[:8]}"
    try:
        for rows in ([("ann", 32)], [("ben", 3), ("cy", 75)]):
            write_table(literal_rows(spark, rows, ["first_name", "age"]), name)
        assert sorted(r["age"] for r in catalog_table(spark, name).collect()) == [3, 75]
        assert spark.catalog.getTable(name).tableType == "MANAGED"
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_score_of_missing_feature_is_null(spark):
    model = LinearModel(("light",), (1.0,), 0.0)
    values = [None, 1.0, -1.0, 0.0, float("nan"), -1e6, 1e6]
    df = spark.createDataFrame([(v,) for v in values], "light double")
    predictions = [r["prediction"] for r in with_score(df, model).collect()]
    assert predictions == [None, 1.0, 0.0, 0.0, None, 0.0, 1.0]


def test_hash_split_ignores_partitions(spark):
    df = spark.range(5000)
    train, test = hash_split(df, "id")
    again, _ = hash_split(df.repartition(13), "id")
    assert {r[0] for r in train.collect()} == {r[0] for r in again.collect()}
    assert train.count() + test.count() == 5000
    assert 0.65 < df.filter(in_train("id")).count() / 5000 < 0.75
