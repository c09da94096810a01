"""Batch queries: ingest, rules, routing, aggregates, sources and sinks."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.config import Settings
from roompulse.functions.ingest import (
    epoch_to_timestamp,
    iso_text,
    parse_readings,
    scan_line,
    timestamp_text,
    to_json_value,
    with_ingest_time,
)
from roompulse.functions.rules import comfort_label, life_stage, prediction_text
from roompulse.functions.scoring import LinearModel, with_score
from roompulse.operators.carry_forward import carry_forward
from roompulse.operators.evaluation import area_under_roc, confusion_counts as count_confusion
from roompulse.operators.export import first_documents, hits_total as count_hits, preview
from roompulse.operators.occupancy import (
    approximate_occupancy, exact_occupancy, latest_windows, sketched_occupancy,
)
from roompulse.operators.routing import device_route, environment_route
from roompulse.operators.split import TRAIN_SHARE, in_train, random_split
from roompulse.plans.catalog import READINGS_SQL, query
from roompulse.plans.readings import (
    epoch_seconds, events, mac, messages, readings, rssi, sightings, table,
)
from roompulse.schemas import ENVIRONMENT_READING, ROOM_READING, TRAINING_ROW
from roompulse.sinks.batch import (
    write_csv, write_index, write_json_lines, write_lines, write_table, write_topic,
)
from roompulse.sources.files import read_appended_csv, read_csv, read_lines, two_field_rows
from roompulse.sources.index import read_index
from roompulse.sources.tables import catalog_table
from roompulse.sources.topics import replay_topic
from roompulse.workspace import new_folder

# A model with fixed weights, so that its scores can be checked in SQL.
FIXED_MODEL = LinearModel(("light", "temperature", "humidity"), (0.01, -0.2, -0.1), 6.0)
PROBABILITY_SQL = (
    "1.0::DOUBLE / (1.0::DOUBLE + exp(-(((6.0::DOUBLE + light * 0.01::DOUBLE)"
    " + temperature * (-0.2)::DOUBLE) + humidity * (-0.1)::DOUBLE)))"
)
LABEL_SQL = "CASE WHEN light < 20 OR temperature > 30 OR humidity > 60 THEN 0 ELSE 1 END"

TS_MILLIS = "yyyy-MM-dd HH:mm:ss.SSS"
READING_SQL_COLUMNS = (
    "mac, rssi, temperature, humidity, light, strftime(parsed_ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp"
)


def with_time_text(df: DataFrame) -> DataFrame:
    """The timestamp as text with microseconds, the same under any client time zone."""
    return df.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def file_settings(spark: SparkSession, name: str) -> Settings:
    """Settings with topics and indices as parquet folders of the same shape."""
    root = new_folder(spark, name)
    return Settings(
        stream_format="parquet", stream_root=f"{root}/topics",
        index_format="parquet", index_root=f"{root}/indices",
    )


# --- ingest -----------------------------------------------------------------------------------

@query("SELECT event_id, CAST(props::JSON->>'k' AS INTEGER) AS k FROM events")
def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse a JSON text column with a declared schema and expand the struct."""
    rows = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int").alias("p"))
    return rows.select("event_id", "p.*")


@query(READINGS_SQL + f"SELECT {READING_SQL_COLUMNS} FROM readings")
def kafka_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of a message envelope to typed readings."""
    return with_time_text(parse_readings(messages(events(spark, sf_dir)), ROOM_READING))


@query(READINGS_SQL + """
SELECT light, temperature, humidity, strftime(parsed_ts, '%Y-%m-%dT%H:%M:%S.%g') || '+0000' AS timestamp
FROM readings""")
def environment_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Environment readings with ISO text, as the index stores them."""
    rows = parse_readings(messages(events(spark, sf_dir)), ENVIRONMENT_READING)
    return rows.withColumn("timestamp", iso_text("timestamp"))


@query("""
WITH r AS (
  SELECT event_id % 8 AS damage FROM events
)
SELECT CAST(damage AS BIGINT) AS damage, count(*) AS n,
  sum(CASE WHEN damage IN (1, 2, 3) THEN 1 ELSE 0 END)::BIGINT AS no_mac,
  sum(CASE WHEN damage IN (1, 2, 3, 4, 6, 7) THEN 1 ELSE 0 END)::BIGINT AS no_rssi,
  sum(CASE WHEN damage IN (1, 2, 3, 4) THEN 1 ELSE 0 END)::BIGINT AS no_temperature,
  sum(CASE WHEN damage IN (1, 2, 3, 4, 7) THEN 1 ELSE 0 END)::BIGINT AS no_light,
  sum(CASE WHEN damage IN (1, 2, 3) THEN 1 ELSE 0 END)::BIGINT AS no_timestamp
FROM r GROUP BY damage""")
def json_parse_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs per column for good messages (0, 5) and for six kinds of damaged ones."""
    good = F.col("value").cast("string")
    kind = F.col("offset") % 8
    damaged = (
        F.when(kind == 1, "garbage")
        .when(kind == 2, "null")
        .when(kind == 3, "")
        .when(kind == 4, F.concat(F.lit('{"mac":"x","humidity":1,"timestamp":'), F.col("offset"), F.lit("}")))
        .when(kind == 5, F.regexp_replace(good, r"^\{", '{"extra":[1,{"a":2}],'))
        .when(kind == 6, F.regexp_replace(good, r'"rssi":-?\d+', '"rssi":-5.5'))
        .when(kind == 7, F.regexp_replace(
            F.regexp_replace(good, r'"rssi":(-?\d+)', '"rssi":"$1"'), r'"light":[^,]+', '"light":"7"'))
        .otherwise(good)
    )
    raw = messages(events(spark, sf_dir)).select(kind.alias("damage"), damaged.alias("value"))
    parsed = raw.select("damage", F.from_json("value", ROOM_READING).alias("p")).select("damage", "p.*")
    return parsed.groupBy("damage").agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.sum(F.col(name).isNull().cast("long")).alias(f"no_{name}")
            for name in ("mac", "rssi", "temperature", "light", "timestamp")
        ],
    )


@query(READINGS_SQL + """
SELECT event_id, strftime(parsed_ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp FROM readings""")
def epoch_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", epoch_seconds().alias("epoch"))
    return with_time_text(rows.select("event_id", epoch_to_timestamp("epoch").alias("timestamp")))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+0000' AS iso FROM events")
def ts_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", iso_text("ts").alias("iso"))


@query("""
SELECT event_id, regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '\\.?0+$', '') AS text
FROM events""")
def ts_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain text of a timestamp: trailing zeros of the fraction are not written."""
    return events(spark, sf_dir).select("event_id", timestamp_text("ts").alias("text"))


def scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan lines in five spellings, from clean to unusable, one per type of event."""
    number = rssi().cast("string")
    kind = F.col("event_type")
    tail = (
        F.when(kind == "click", F.concat(F.lit(","), number))
        .when(kind == "view", F.concat(F.lit(", "), number, F.lit(" ")))
        .when(kind == "signup", F.lit(""))
        .when(kind == "error", F.lit(",x"))
        .otherwise(F.concat(F.lit(","), number, F.lit(",z")))
    )
    return events(spark, sf_dir).select("event_id", F.concat(mac(), tail).alias("value"))


@query(READINGS_SQL + """
SELECT event_id,
  CASE WHEN event_type NOT IN ('signup', 'error') THEN mac END AS mac,
  CASE WHEN event_type NOT IN ('signup', 'error') THEN rssi END AS rssi
FROM readings""")
def csv_line_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan lines to records; an unusable line is a record of NULLs."""
    parsed = scan_lines(spark, sf_dir).select("event_id", scan_line("value").alias("r"))
    return parsed.select("event_id", "r.*")


@query(READINGS_SQL + """
SELECT mac AS mac_address,
  CASE event_type WHEN 'click' THEN rssi::VARCHAR WHEN 'view' THEN ' ' || rssi || ' ' ELSE 'x' END AS rssi
FROM readings WHERE event_type IN ('click', 'view', 'error')""")
def csv_arity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only lines with exactly two fields, both as text; one- and three-field lines are no records."""
    return two_field_rows(scan_lines(spark, sf_dir), "mac_address", "rssi")


@query(READINGS_SQL + """
SELECT '{"mac":"' || mac || '","rssi":' || rssi || ',"timestamp":"'
  || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+0000"}' AS value
FROM readings""", name="to_json_value")
def published_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings as the JSON text that is published."""
    rows = events(spark, sf_dir).select(mac(), rssi(), iso_text("ts").alias("timestamp"))
    return to_json_value(rows, "mac", "rssi", "timestamp")


@query(READINGS_SQL + f"SELECT {READING_SQL_COLUMNS} FROM readings")
def to_json_value_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings to JSON values and back through the parser."""
    rows = readings(events(spark, sf_dir)).drop("event_id")
    return with_time_text(parse_readings(to_json_value(rows), ROOM_READING))


@query(READINGS_SQL + f"SELECT {READING_SQL_COLUMNS} FROM readings")
def topic_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish a topic, then read it from the beginning."""
    settings = file_settings(spark, "topic_replay")
    write_topic(readings(events(spark, sf_dir)).drop("event_id"), settings)
    return with_time_text(parse_readings(replay_topic(spark, settings), ROOM_READING))


@query(READINGS_SQL + "SELECT event_id, mac, rssi, temperature, humidity, light, TRUE AS in_run FROM readings")
def ingest_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with the time of ingestion in place of their own: it lies within the run."""
    begun = time.time()
    stamped = with_ingest_time(readings(events(spark, sf_dir)).drop("timestamp"))
    in_run = F.col("timestamp").between(begun - 1, F.unix_micros(F.current_timestamp()) / F.lit(1e6) + 1)
    return stamped.withColumn("in_run", in_run).drop("timestamp")


@query("SELECT event_id % 7 AS comfortable, value AS humidity, event_id::DOUBLE AS light, value * 2 AS temperature FROM events")
def csv_scan_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with the columns in another order, and one more: they are found by name, by both readers."""
    root = new_folder(spark, "csv_scan_reordered")
    rows = table(spark, sf_dir, "events").select(
        F.lit("x").alias("other"), F.col("value").alias("humidity"), (F.col("event_id") % 7).alias("comfortable"),
        F.col("event_id").cast("double").alias("light"), (F.col("value") * 2).alias("temperature"))
    write_csv(rows.where("light % 2 = 0"), f"{root}/even")
    write_csv(rows.where("light % 2 = 1"), f"{root}/odd")
    return read_csv(spark, f"{root}/even", TRAINING_ROW).unionByName(
        read_appended_csv(spark, f"{root}/odd", TRAINING_ROW)).withColumn("comfortable", F.col("comfortable").cast("long"))


# --- routing and rules ------------------------------------------------------------------------

@query(READINGS_SQL + "SELECT event_id, temperature, humidity, light, epoch AS timestamp FROM readings")
def route_env(spark: SparkSession, sf_dir: str) -> DataFrame:
    return environment_route(readings(events(spark, sf_dir)))


@query(READINGS_SQL + "SELECT event_id, mac, rssi, epoch AS timestamp FROM readings")
def route_macs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return device_route(readings(events(spark, sf_dir)))


@query(READINGS_SQL + f"SELECT event_id, CAST({LABEL_SQL} AS INTEGER) AS comfortable FROM readings",
       name="comfort_label")
def label_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(events(spark, sf_dir)).select("event_id", comfort_label().alias("comfortable"))


@query(READINGS_SQL + """
SELECT event_id, CAST(CASE WHEN light > 20 OR temperature > 30 OR humidity > 60 THEN 0 ELSE 1 END AS INTEGER)
  AS comfortable
FROM readings""")
def comfort_label_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(events(spark, sf_dir)).select(
        "event_id", comfort_label(light_rule="above").alias("comfortable")
    )


@query(READINGS_SQL + f"""
SELECT event_id, light, temperature, humidity, CAST(0 AS INTEGER) AS comfortable
FROM readings WHERE ({LABEL_SQL}) = 0""")
def comfort_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(events(spark, sf_dir)).select(
        "event_id", "light", "temperature", "humidity", comfort_label().alias("comfortable")
    )
    return rows.filter(F.col("comfortable") == 0)


@query(READINGS_SQL + """
SELECT event_id, CASE WHEN event_id % 3 = 1 THEN 'comfortable' ELSE 'not comfortable' END AS prediction_str
FROM readings""", name="prediction_text")
def prediction_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions 0, 1 and NULL as text."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.nullif(F.col("event_id") % 3, F.lit(2)).cast("double").alias("prediction")
    )
    return rows.select("event_id", prediction_text().alias("prediction_str"))


# --- buckets and group means ------------------------------------------------------------------

LIFE_STAGE_SQL = (
    "CASE WHEN p_size < 13 THEN 'child' WHEN p_size BETWEEN 13 AND 19 THEN 'teenager' ELSE 'adult' END"
)


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").alias("age"), "p_retailprice"
    ).withColumn("life_stage", life_stage())


@query(f"SELECT p_partkey, p_size AS age, {LIFE_STAGE_SQL} AS life_stage FROM part")
def life_stage_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people(spark, sf_dir).drop("p_retailprice")


LIFE_STAGE_AVG_SQL = f"""
SELECT {LIFE_STAGE_SQL} AS life_stage, round(avg(p_size), 6) AS mean_age,
  round(avg(p_retailprice), 4) AS mean_price
FROM part GROUP BY 1"""


@query(LIFE_STAGE_AVG_SQL)
def life_stage_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group means, as a dictionary of aggregates."""
    means = people(spark, sf_dir).groupBy("life_stage").agg({"age": "mean", "p_retailprice": "mean"})
    return means.select(
        "life_stage",
        F.round("avg(age)", 6).alias("mean_age"),
        F.round("avg(p_retailprice)", 4).alias("mean_price"),
    )


@query(LIFE_STAGE_AVG_SQL)
def life_stage_avg_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group means in SQL over a saved table."""
    name = f"people_{uuid.uuid4().hex[:12]}"
    write_table(people(spark, sf_dir), name, new_folder(spark, name))
    return spark.sql(f"""
        SELECT life_stage, round(avg(age), 6) AS mean_age, round(avg(p_retailprice), 4) AS mean_price
        FROM {name} GROUP BY life_stage""")


@query(f"SELECT p_partkey, p_size AS age, {LIFE_STAGE_SQL} AS life_stage FROM part WHERE p_size < 20")
def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan a saved catalog table with a pushed-down filter."""
    name = f"people_{uuid.uuid4().hex[:12]}"
    write_table(people(spark, sf_dir), name, new_folder(spark, name))
    return catalog_table(spark, name).filter("age < 20").select("p_partkey", "age", "life_stage")


# --- evaluation and scoring -------------------------------------------------------------------

def fixed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(events(spark, sf_dir)).withColumn("label", comfort_label())
    return with_score(rows, FIXED_MODEL)


@query(READINGS_SQL + f"""
SELECT label, prediction, count(*) AS count FROM (
  SELECT CAST({LABEL_SQL} AS INTEGER) AS label,
         CASE WHEN {PROBABILITY_SQL} > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM readings) GROUP BY 1, 2""")
def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_confusion(fixed_scores(spark, sf_dir))


@query(READINGS_SQL + f""", scored AS (
  SELECT {LABEL_SQL} AS label, {PROBABILITY_SQL} AS score FROM readings
), ranked AS (
  SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r
  FROM scored
), sums AS (
  SELECT sum(CASE WHEN label = 1 THEN r ELSE 0 END) AS rank_sum,
         sum(label)::DOUBLE AS n1, sum(1 - label)::DOUBLE AS n0
  FROM ranked
)
SELECT round((rank_sum - n1 * (n1 + 1) / 2) / (n1 * n0), 6) AS auc FROM sums""")
def auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under the ROC curve over every distinct score."""
    rows = fixed_scores(spark, sf_dir).select(F.col("label").cast("double"), "probability")
    auc = area_under_roc(rows, score="probability", bins=0)
    return spark.createDataFrame([(round(auc, 6),)], "auc double")


@query(READINGS_SQL + f"""
SELECT event_id, round({PROBABILITY_SQL}, 6) AS probability,
  CASE WHEN {PROBABILITY_SQL} > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
FROM readings""")
def lr_score_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic-regression scores as column arithmetic."""
    return fixed_scores(spark, sf_dir).select(
        "event_id", F.round("probability", 6).alias("probability"), "prediction"
    )


@query("""
SELECT l_orderkey, l_linenumber,
  round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(((0.5::DOUBLE + l_quantity * 0.05::DOUBLE)
    + l_discount * 4.0::DOUBLE) + l_tax * (-30.0)::DOUBLE))), 6) AS probability
FROM lineitem""")
def lr_score_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scoring over a larger table with other features."""
    model = LinearModel(("l_quantity", "l_discount", "l_tax"), (0.05, 4.0, -30.0), 0.5)
    return with_score(table(spark, sf_dir, "lineitem"), model).select(
        "l_orderkey", "l_linenumber", F.round("probability", 6).alias("probability")
    )


@query("""
SELECT event_id,
  CAST(('0x' || substr(md5(event_id::VARCHAR), 1, 8))::UBIGINT % 10 < 7 AS INTEGER) AS in_train
FROM events""")
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", in_train("event_id").cast("int").alias("in_train"))


@query("SELECT event_id, 1 AS times, TRUE AS share_is_close FROM events")
def split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark's own random split: each row is on one side, and the sides have their shares."""
    train, test = random_split(table(spark, sf_dir, "events").select("event_id"))
    marked = train.withColumn("in_train", F.lit(1)).unionByName(test.withColumn("in_train", F.lit(0)))
    rows, share = marked.agg(F.count(F.lit(1)), F.avg("in_train")).first()
    # Five standard deviations of a share of this many draws.
    is_close = rows == 0 or abs(share - TRAIN_SHARE) < 5 * (TRAIN_SHARE * (1 - TRAIN_SHARE) / rows) ** 0.5
    return marked.groupBy("event_id").agg(F.count(F.lit(1)).cast("int").alias("times")).withColumn(
        "share_is_close", F.lit(is_close))


# --- occupancy --------------------------------------------------------------------------------

OCCUPANCY_SQL = """
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(s + INTERVAL 2 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
  count(DISTINCT user_id) AS distinct_macs, round(count(DISTINCT user_id) / 3.0::DOUBLE, 6) AS approx_people
FROM (
  SELECT time_bucket(INTERVAL 30 SECOND, ts) - to_seconds(30 * i) AS s, user_id
  FROM events, range(4) t(i)
) GROUP BY s"""


def occupancy_text(windows: DataFrame) -> DataFrame:
    return windows.select(
        F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.date_format("end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        "distinct_macs",
        F.round("approx_people", 6).alias("approx_people"),
    )


@query(OCCUPANCY_SQL)
def occupancy_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct devices and people per two-minute window, every 30 seconds."""
    return occupancy_text(exact_occupancy(sightings(events(spark, sf_dir))))


# Sketches are checked where there is something to estimate: windows of a day, a new one every twelve hours.
DAY, HALF_DAY = 86_400, 43_200
DAYS_SQL = """
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(s + INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
  count(DISTINCT user_id) AS devices, TRUE AS is_close
FROM (
  SELECT time_bucket(INTERVAL 12 HOUR, ts) - to_hours(12 * i) AS s, user_id FROM events, range(2) t(i)
) GROUP BY s"""


def held_against_exact(spark: SparkSession, sf_dir: str, estimates: DataFrame) -> DataFrame:
    """Exact devices of each estimated window, and whether the estimate is within three standard errors of 5 %."""
    day = F.window("timestamp", f"{DAY} seconds", f"{HALF_DAY} seconds")
    exact = sightings(events(spark, sf_dir)).groupBy(day.alias("w")).agg(F.count_distinct("mac").alias("devices"))
    exact = exact.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "devices")
    found = occupancy_text(estimates).join(exact, "window_start")
    is_close = F.abs(F.col("distinct_macs") - F.col("devices")) <= F.col("devices") * 0.15
    return found.select("window_start", "window_end", "devices", is_close.alias("is_close"))


@query(DAYS_SQL)
def occupancy_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupancy with sketches, which are allowed an error of 5 %, held against exact counts."""
    return held_against_exact(
        spark, sf_dir, approximate_occupancy(sightings(events(spark, sf_dir)), DAY, HALF_DAY))


@query(DAYS_SQL)
def occupancy_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mergeable sketches per pane, merged per window, held against exact counts."""
    return held_against_exact(spark, sf_dir, sketched_occupancy(sightings(events(spark, sf_dir)), DAY, HALF_DAY))


@query(f"""
SELECT window_start, window_end, distinct_macs, TRUE AS approx_is_close, TRUE AS sketch_is_close
FROM ({OCCUPANCY_SQL})""")
def occupancy_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact counts of all windows, and whether both approximate forms come close to them."""
    rows = sightings(events(spark, sf_dir))
    exact = occupancy_text(exact_occupancy(rows)).drop("approx_people")
    keys = ["window_start", "window_end"]
    for name, windows in (("approx", approximate_occupancy(rows)), ("sketch", sketched_occupancy(rows))):
        other = occupancy_text(windows).select(*keys, F.col("distinct_macs").alias("estimate"))
        error = F.abs(F.col("estimate") - F.col("distinct_macs"))
        is_close = error <= F.greatest(F.lit(1), F.col("distinct_macs") * 0.15)
        exact = exact.join(other, keys, "full").withColumn(f"{name}_is_close", is_close).drop("estimate")
    return exact


@query(f"SELECT * FROM ({OCCUPANCY_SQL}) ORDER BY window_start DESC LIMIT 20")
def occupancy_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 20 windows, newest first."""
    return occupancy_text(latest_windows(exact_occupancy(sightings(events(spark, sf_dir))), 20))


# --- carry-forward ----------------------------------------------------------------------------

CARRY_FORWARD_SQL = """
WITH feed AS (
  SELECT event_id, user_id, ts,
    CASE WHEN event_type = 'view' THEN value END AS light,
    CASE WHEN event_type = 'error' THEN value END AS temperature,
    CASE WHEN event_type = 'click' THEN CAST(-CAST(props::JSON->>'k' AS INTEGER) AS INTEGER) END AS rssi
  FROM events
)
SELECT event_id, user_id,
  last_value(light IGNORE NULLS) OVER w AS light,
  last_value(temperature IGNORE NULLS) OVER w AS temperature,
  last_value(rssi IGNORE NULLS) OVER w AS rssi
FROM feed
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

FEED_COLUMNS = ["light", "temperature", "rssi"]


def sensor_feed(source: DataFrame) -> DataFrame:
    """One sensor value per row; the other sensors are NULL until they speak again."""
    kind = F.col("event_type")
    return source.select(
        "event_id", "user_id", "ts",
        F.when(kind == "view", F.col("value")).alias("light"),
        F.when(kind == "error", F.col("value")).alias("temperature"),
        F.when(kind == "click", rssi()).alias("rssi"),
    )


@query(CARRY_FORWARD_SQL)
def locf_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last known value of every sensor per device."""
    feed = sensor_feed(events(spark, sf_dir))
    return carry_forward(feed, "user_id", ["ts", "event_id"], FEED_COLUMNS).drop("ts")


@query(CARRY_FORWARD_SQL)
def locf_merge_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with each device cut into days, for devices with a large share of the rows."""
    feed = sensor_feed(events(spark, sf_dir))
    day = F.col("ts").cast("date")
    return carry_forward(feed, "user_id", ["ts", "event_id"], FEED_COLUMNS, day).drop("ts")


# --- files, tables, index ---------------------------------------------------------------------

@query(READINGS_SQL + f"""
SELECT light, temperature, humidity, CAST({LABEL_SQL} AS INTEGER) AS comfortable FROM readings""")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write labelled readings as CSV with a header, scan them with the training schema."""
    path = new_folder(spark, "csv_scan")
    rows = readings(events(spark, sf_dir))
    write_csv(rows.select("light", "temperature", "humidity", comfort_label().alias("comfortable")), path)
    return read_csv(spark, path, TRAINING_ROW)


@query(READINGS_SQL + f"""
SELECT light, temperature, humidity, CAST({LABEL_SQL} AS INTEGER) AS comfortable FROM readings""")
def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with inferred types."""
    path = new_folder(spark, "csv_scan_inferred")
    rows = readings(events(spark, sf_dir))
    write_csv(rows.select("light", "temperature", "humidity", comfort_label().alias("comfortable")), path)
    return read_csv(spark, path)


@query(READINGS_SQL + f"""
SELECT light, temperature, humidity, CAST({LABEL_SQL} AS INTEGER) AS comfortable FROM readings""")
def csv_repeated_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with header rows between the data rows, as appending writers leave them."""
    path = new_folder(spark, "csv_repeated_header")
    rows = readings(events(spark, sf_dir))
    line = F.concat_ws(",", "light", "temperature", "humidity", comfort_label())
    header = F.lit(",".join(TRAINING_ROW.fieldNames()))
    restarts = F.when(F.col("event_id") % 100 == 0, F.array(header, line)).otherwise(F.array(line))
    write_lines(rows.select(F.explode(restarts).alias("value")), path)
    return read_appended_csv(spark, path, TRAINING_ROW)


@query("SELECT unnest(string_split(text, chr(10))) AS line FROM documents")
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write documents as text, scan the lines."""
    path = new_folder(spark, "text_lines")
    write_lines(table(spark, sf_dir, "documents").select("text"), path)
    return read_lines(spark, path).select(F.col("value").alias("line"))


@query(READINGS_SQL + "SELECT event_id, mac, rssi, temperature, humidity, light, epoch AS timestamp FROM readings")
def json_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write JSON lines, read them with their schema."""
    path = new_folder(spark, "json_lines")
    rows = readings(events(spark, sf_dir))
    write_json_lines(rows, path)
    return spark.read.schema(rows.schema).json(path)


def indexed_readings(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Readings written to an index and scanned back."""
    settings = file_settings(spark, name)
    rows = readings(events(spark, sf_dir)).withColumn(
        "timestamp", iso_text(epoch_to_timestamp("timestamp"))
    )
    write_index(rows, settings, "macs_raw")
    return read_index(spark, settings, "macs_raw")


INDEXED_SQL = READINGS_SQL + """
SELECT event_id, mac, rssi, temperature, humidity, light,
  strftime(parsed_ts, '%Y-%m-%dT%H:%M:%S.%g') || '+0000' AS timestamp
FROM readings"""


@query(INDEXED_SQL)
def export_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export a whole index as CSV, read the export back."""
    path = new_folder(spark, "export_csv")
    rows = indexed_readings(spark, sf_dir, "export_index")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


@query("SELECT event_id, event_type, props, text FROM (SELECT event_id, event_type, props,"
       " event_type || ', \"' || props || '\"' AS text FROM events)")
def export_csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values with commas and quotes survive the export."""
    path = new_folder(spark, "export_csv_quoted")
    rows = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "props",
        F.concat("event_type", F.lit(', "'), "props", F.lit('"')).alias("text"),
    )
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


@query(INDEXED_SQL + " ORDER BY event_id LIMIT 1000")
def export_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The short export: the first 1,000 documents."""
    return first_documents(indexed_readings(spark, sf_dir, "export_first_n"), ["event_id"])


@query("SELECT count(*) AS hits FROM events")
def hits_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_hits(table(spark, sf_dir, "events"))


@query(READINGS_SQL + """
SELECT event_id, mac, rssi, temperature, humidity, light, epoch AS timestamp FROM readings
ORDER BY light DESC, event_id LIMIT 100""")
def preview_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brightest 100 readings."""
    return preview(readings(events(spark, sf_dir)), [F.col("light").desc(), F.col("event_id")], 100)
