"""Model queries. Fitted weights are not expressible in SQL; what they must satisfy is."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.functions.rules import comfort_label
from roompulse.functions.scoring import with_score
from roompulse.operators.comfort_model import (
    QUALITY_GATE, evaluate, linear_model, load, save_if_good, score, train,
)
from roompulse.operators.evaluation import rank_area
from roompulse.operators.split import hash_split
from roompulse.plans.batch import READING_SQL_COLUMNS, file_settings, with_time_text
from roompulse.plans.catalog import READINGS_SQL, query
from roompulse.plans.jobs import score_file
from roompulse.plans.readings import events, messages, readings
from roompulse.schemas import SENSOR_COLUMNS
from roompulse.sinks.batch import write_csv
from roompulse.sinks.stream import drain, to_index
from roompulse.sources.index import read_index
from roompulse.sources.topics import stream_topic
from roompulse.streaming.scoring import score_messages
from roompulse.workspace import new_folder


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with their label. A fixed share of labels is turned, so the classes overlap."""
    rows = readings(events(spark, sf_dir))
    turned = F.pmod(F.xxhash64("event_id"), F.lit(20)) == 0
    label = comfort_label()
    return rows.withColumn("comfortable", F.when(turned, 1 - label).otherwise(label))


def scored_columns(scored: DataFrame) -> DataFrame:
    return scored.select(
        "event_id", "comfortable",
        F.round(vector_to_array("probability")[1], 6).alias("probability"), "prediction",
    )


TEST_SQL = "NOT ('0x' || substr(md5(event_id::VARCHAR), 1, 8))::UBIGINT % 10 < 7"


def is_optimal(rows: DataFrame, model) -> bool:
    """Whether the fit is the maximum of the likelihood: residuals sum to 0, alone and with each feature.

    The sums are taken per row and in units of the feature's standard deviation.
    """
    residual = F.col("p") - F.col("comfortable")
    scored = score(rows, model).withColumn("p", vector_to_array("probability")[1])
    sums = scored.agg(F.avg(residual), *[F.avg(residual * F.col(c)) / F.stddev(c) for c in SENSOR_COLUMNS]).first()
    return all(abs(value) < 1e-3 for value in sums)


@query(f"""
SELECT event_id, TRUE AS prediction_follows, TRUE AS is_probability, TRUE AS fit_is_optimal
FROM events WHERE {TEST_SQL}""")
def lr_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the train side of a hash split, score the test side; the fit is the optimum of the train side."""
    train_rows, test_rows = hash_split(labelled(spark, sf_dir), "event_id")
    model = train(train_rows)
    p = vector_to_array("probability")[1]
    return score(test_rows, model).select(
        "event_id", (F.col("prediction") == (p > 0.5).cast("double")).alias("prediction_follows"),
        p.between(0, 1).alias("is_probability"), F.lit(is_optimal(train_rows, model)).alias("fit_is_optimal"))


@query("SELECT event_id, TRUE AS as_before FROM events")
def lr_reload_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, evaluate, save behind the quality gate, load again and score everything."""
    path = new_folder(spark, "comfort_model")
    rows = labelled(spark, sf_dir)
    train_rows, test_rows = hash_split(rows, "event_id")
    model = train(train_rows)
    report = evaluate(score(test_rows, model))
    if not save_if_good(model, report, path):
        raise ValueError(f"area under the curve {report.auc} does not beat the gate")
    before = scored_columns(score(rows, model)).withColumnsRenamed({"probability": "p", "prediction": "was"})
    after = scored_columns(score(rows, load(path))).drop("comfortable")
    same = (F.col("p") == F.col("probability")) & (F.col("was") == F.col("prediction"))
    return before.join(after, "event_id", "full").select("event_id", F.coalesce(same, F.lit(False)).alias("as_before"))


@query("SELECT event_id, TRUE AS as_before FROM events")
def lr_bare_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save a fitted model without its assembler, load it with the stated order of features, and score everything."""
    path, order = new_folder(spark, "bare_model"), ["temperature", "humidity", "light"]
    rows = labelled(spark, sf_dir)
    model = train(rows, features=order)
    model.stages[-1].write().save(path)
    before = scored_columns(score(rows, model)).withColumnsRenamed({"probability": "p", "prediction": "was"})
    after = scored_columns(score(rows, load(path, order))).drop("comfortable")
    same = (F.col("p") == F.col("probability")) & (F.col("was") == F.col("prediction"))
    return before.join(after, "event_id", "full").select("event_id", F.coalesce(same, F.lit(False)).alias("as_before"))


@query(f"""
SELECT count(*) AS rows, TRUE AS accuracy_is_share, TRUE AS auc_is_rank_share, TRUE AS beats_gate
FROM events WHERE {TEST_SQL}""")
def lr_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on the test side: its counts, accuracy and area under the curve held against their definitions."""
    train_rows, test_rows = hash_split(labelled(spark, sf_dir), "event_id")
    scored = score(test_rows, train(train_rows))
    report = evaluate(scored)
    area = rank_area(scored.withColumn("s", vector_to_array("rawPrediction")[1]), "comfortable", "s")
    right = scored.agg(F.avg((F.col("prediction") == F.col("comfortable")).cast("double"))).first()[0]
    return report.confusion.agg(F.sum("count").alias("rows")).select(
        "rows", F.lit(abs(report.accuracy - right) < 1e-9).alias("accuracy_is_share"),
        F.lit(abs(report.auc - area) < 1e-6).alias("auc_is_rank_share"), F.lit(report.auc > QUALITY_GATE).alias("beats_gate"))


@query(READINGS_SQL + f"SELECT {READING_SQL_COLUMNS}, TRUE AS as_batch FROM readings")
def train_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit at start, then score the stream with the fitted model."""
    settings = file_settings(spark, "train_then_stream")
    messages(events(spark, sf_dir)).write.parquet(settings.topic_path(settings.topic))
    model = train(labelled(spark, sf_dir))
    scored, _ = score_messages(stream_topic(spark, settings), model)
    checkpoints = new_folder(spark, "train_then_stream_checkpoints")
    drain(to_index(scored, "train_then_stream", checkpoints, settings), spark)
    # The batch form of the same model gives each document its prediction again.
    found = read_index(spark, settings).withColumnRenamed("prediction", "streamed")
    again = with_score(found, linear_model(model))
    return with_time_text(again).select(
        "mac", "rssi", "temperature", "humidity", "light", "timestamp", (F.col("streamed") == F.col("prediction")).alias("as_batch"))


@query("""
SELECT CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'scored' END AS side, count(*) AS n, sum(event_id)::DOUBLE AS light
FROM events GROUP BY ALL""")
def score_file_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score a file in which some rows lack a feature: scored and rejected together are the input."""
    root = new_folder(spark, "score_file_rejects")
    train(labelled(spark, sf_dir)).write().overwrite().save(f"{root}/model")
    rows = events(spark, sf_dir).select(
        F.lit(40.0).alias("humidity"), F.col("event_id").cast("double").alias("light"),
        F.when(F.col("event_type") != "error", "21.5").otherwise("x").alias("temperature"),
        F.when(F.col("event_id") % 3 > 0, F.col("event_id") % 2).alias("comfortable"))
    write_csv(rows, f"{root}/rows")
    scored, _, rejected = score_file(spark, f"{root}/rows", f"{root}/model", f"{root}/rejected")
    sides = scored.select(F.lit("scored").alias("side"), "light").unionByName(
        rejected.select(F.lit("rejected").alias("side"), "light"))
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("light").alias("light"))
