"""Log parsing queries: lines in each format are derived from the events, parsed and compared.

Purchases leave a line that no format knows, so every parser also has something to reject.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.functions.logs import (
    clf_timestamp, iso_timestamp, logfmt_fields, parse_json_log, parse_log, with_log_time,
)
from roompulse.plans.batch import TS_MILLIS
from roompulse.plans.catalog import query
from roompulse.plans.jobs import parse_logs
from roompulse.plans.readings import events
from roompulse.sinks.batch import write_lines
from roompulse.workspace import new_folder

SYSLOG_YEAR = 2024

# The pieces that lines are made of, in SQL.
PIECES_SQL = """
WITH pieces AS (
  SELECT event_id, event_type, user_id, '/e/' || event_id AS path, '10.0.0.' || user_id AS host,
    'm' || user_id AS usr, CAST(200 + event_id % 5 AS VARCHAR) AS code,
    CAST(event_id * 7 AS VARCHAR) AS size, 'agent ' || event_type AS agent,
    props::JSON->>'k' AS k,
    strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000' AS clf,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS iso,
    strftime(ts, '%b ') || lpad(CAST(day(ts) AS VARCHAR), 2, ' ') || strftime(ts, ' %H:%M:%S') AS bsd,
    strftime(ts, '%Y-%m-%d %H:%M:%S.000') AS second,
    strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS milli
  FROM events WHERE event_type <> 'purchase'
)
"""


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    day = F.lpad(F.dayofmonth("ts").cast("string"), 2, " ")
    return rows.select(
        "event_id", "event_type", "user_id",
        F.concat(F.lit("/e/"), "event_id").alias("path"),
        F.concat(F.lit("10.0.0."), "user_id").alias("host"),
        F.concat(F.lit("m"), "user_id").alias("usr"),
        (F.lit(200) + F.col("event_id") % 5).cast("string").alias("code"),
        (F.col("event_id") * 7).cast("string").alias("size"),
        F.concat(F.lit("agent "), "event_type").alias("agent"),
        F.from_json("props", "k string")["k"].alias("k"),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss Z").alias("clf"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("iso"),
        F.concat_ws(" ", F.date_format("ts", "MMM"), day, F.date_format("ts", "HH:mm:ss")).alias("bsd"),
        F.md5(F.col("event_id").cast("string")).alias("digest"),
    )


def template(text: str) -> Column:
    """``text`` with each ``{column}`` replaced by that column."""
    parts = re.split(r"\{(\w+)\}", text)
    columns = [F.lit(part) if i % 2 == 0 else F.col(part) for i, part in enumerate(parts) if part]
    return F.concat(*columns)


def lines(spark: SparkSession, sf_dir: str, line: Column) -> DataFrame:
    unknown = F.col("event_type") == "purchase"
    rows = pieces(spark, sf_dir)
    return rows.select(F.when(unknown, template("sold,{event_id}")).otherwise(line).alias("value"))


def parsed(spark: SparkSession, sf_dir: str, name: str, line: Column) -> DataFrame:
    fields, _ = parse_log(lines(spark, sf_dir, line), name)
    timed = with_log_time(fields, name, SYSLOG_YEAR)
    if "log_time" in timed.columns:
        timed = timed.withColumn("log_time", F.date_format("log_time", TS_MILLIS))
    return timed


@query("""
SELECT event_type <> 'purchase' AS matched, CASE WHEN event_type = 'purchase' THEN 'sold,' || event_id END AS line,
  CASE WHEN event_type <> 'purchase' THEN 'stdout' END AS stream,
  CASE WHEN event_type <> 'purchase' THEN 'seen ' || event_id END AS message
FROM events""")
def log_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log job in one pass: parsed and rejected lines as one table in two parts."""
    root = new_folder(spark, "log_job")
    write_lines(lines(spark, sf_dir, template("2024-01-01T00:00:00Z stdout F seen {event_id}")), f"{root}/logs")
    parse_logs(spark, f"{root}/logs", "cri", f"{root}/out")
    rows = spark.read.json(f"{root}/out").withColumn("matched", F.col("matched").cast("boolean"))
    return rows.select("matched", F.when(~F.col("matched"), F.col("value")).alias("line"),
                       "fields.stream", "fields.message")


@query("""
SELECT f AS format, event_type <> 'purchase' AS matched, CASE WHEN event_type = 'purchase' THEN 'sold,' || event_id END AS line,
  CASE WHEN event_type <> 'purchase' AND f = 'docker' THEN 'stdout' END AS stream,
  CASE WHEN event_type <> 'purchase' AND f = 'json' THEN event_id END AS id
FROM events, (VALUES ('docker'), ('json')) t(f)""")
def log_job_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log job on container logs and on JSON lines with declared keys: both parts of each."""
    out = None
    for name, line, fields in (
        ("docker", '{"log":"event {event_id}","stream":"stdout","time":"{iso}Z"}', None),
        ("json", '{"level":"{event_type}","id":{event_id}}', ["level", "id long"]),
    ):
        root = new_folder(spark, f"log_job_{name}")
        write_lines(lines(spark, sf_dir, template(line)), f"{root}/logs")
        parse_logs(spark, f"{root}/logs", name, f"{root}/out", fields)
        schema = "value string, fields struct<stream: string, id: long>, matched boolean"
        rows = spark.read.schema(schema).json(f"{root}/out").select(
            F.lit(name).alias("format"), "matched", F.when(~F.col("matched"), F.col("value")).alias("line"), "fields.stream", "fields.id")
        out = rows if out is None else out.unionByName(rows)
    return out


def is_view() -> Column:
    return F.col("event_type") == "view"


def is_signup() -> Column:
    return F.col("event_type") == "signup"


ACCESS_TAIL = ' {code} {size}'
AGENT_TAIL = ' "http://ref/{k}" "{agent}"'
ACCESS_SQL = """usr AS "user", clf AS time, CASE WHEN event_type = 'signup' THEN 'HEAD' ELSE 'GET' END AS method,
  path, code, size"""
# This format's path is optional, but never without a protocol.
APACHE2_SQL = """usr AS "user", clf AS time, CASE WHEN event_type = 'signup' THEN 'HEAD' ELSE 'GET' END AS method,
  CASE WHEN event_type <> 'signup' THEN path END AS path, code, size"""
AGENT_SQL = """CASE WHEN event_type <> 'view' THEN 'http://ref/' || k END AS referer,
  CASE WHEN event_type <> 'view' THEN agent END AS agent"""


def access_request() -> Column:
    return F.when(is_signup(), template('"HEAD {path}"')).otherwise(template('"GET {path} HTTP/1.1"'))


def access_agent() -> Column:
    return F.when(is_view(), F.lit("")).otherwise(template(AGENT_TAIL))


@query(PIECES_SQL + f"SELECT host, {ACCESS_SQL}, {AGENT_SQL}, second AS log_time FROM pieces")
def log_parse_apache(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(
        template("{host} - {usr} [{clf}] "), access_request(), template(ACCESS_TAIL), access_agent()
    )
    return parsed(spark, sf_dir, "apache", line)


@query(PIECES_SQL + f"SELECT host, {APACHE2_SQL}, {AGENT_SQL}, second AS log_time FROM pieces")
def log_parse_apache2(spark: SparkSession, sf_dir: str) -> DataFrame:
    request = F.when(is_signup(), '"HEAD"').otherwise(template('"GET {path} HTTP/1.1"'))
    line = F.concat(
        template("{host} - {usr} [{clf}] "), request, template(ACCESS_TAIL), access_agent()
    )
    return parsed(spark, sf_dir, "apache2", line)


@query(PIECES_SQL + """
SELECT iso AS time, event_type AS level, CASE WHEN event_type <> 'view' THEN k END AS pid,
  CASE WHEN event_type <> 'signup' THEN host END AS client, 'event ' || event_id || ' failed' AS message
FROM pieces""")
def log_parse_apache_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(
        template("[Mon {iso}] [{event_type}]"),
        F.when(is_view(), "").otherwise(template(" [pid {k}]")),
        F.when(is_signup(), "").otherwise(template(" [client {host}]")),
        template(" event {event_id} failed"),
    )
    return parsed(spark, sf_dir, "apache_error", line)


@query(PIECES_SQL + f"""
SELECT '192.168.1.' || user_id AS remote, host, {ACCESS_SQL}, 'http://ref/' || k AS referer, agent,
  second AS log_time
FROM pieces""")
def log_parse_nginx(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(
        template("192.168.1.{user_id} {host} {usr} [{clf}] "), access_request(), template(ACCESS_TAIL),
        template(AGENT_TAIL), F.lit(" trailing words"),
    )
    return parsed(spark, sf_dir, "nginx", line)


@query(PIECES_SQL + f"""
SELECT host, {ACCESS_SQL}, 'http://ref/' || k AS referer, agent, '12' AS request_length,
  '0.0' || k AS request_time, 'up-' || user_id AS proxy_upstream_name,
  CASE WHEN event_type <> 'view' THEN 'alt-' || k END AS proxy_alternative_upstream_name,
  host || ':80' AS upstream_addr, size AS upstream_response_length, '0.1' AS upstream_response_time,
  code AS upstream_status, 'r' || event_id AS reg_id, second AS log_time
FROM pieces""")
def log_parse_k8s_nginx_ingress(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(
        template("{host} - {usr} [{clf}] "), access_request(), template(ACCESS_TAIL), template(AGENT_TAIL),
        template(" 12 0.0{k} [up-{user_id}] "), F.when(is_view(), "").otherwise(template("[alt-{k}] ")),
        template("{host}:80 {size} 0.1 {code} r{event_id}"),
    )
    return parsed(spark, sf_dir, "k8s-nginx-ingress", line)


@query(PIECES_SQL + """
SELECT iso || 'Z' AS time, event_type AS level, 'event ' || event_id || ' of ' || usr AS msg, milli AS log_time
FROM pieces""")
def log_parse_docker_daemon(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = template('time="{iso}Z" level={event_type} msg="event {event_id} of {usr}" module=api')
    return parsed(spark, sf_dir, "docker-daemon", line)


@query(PIECES_SQL + """
SELECT k AS pri, iso || '+00:00' AS time, host, 'app' AS ident,
  CASE WHEN event_type = 'view' THEN '-' ELSE CAST(user_id AS VARCHAR) END AS pid, 'ID' || k AS msgid,
  CASE WHEN event_type = 'signup' THEN '-' ELSE '[x@1 k="' || k || '"]' END AS extradata,
  'event ' || event_id AS message, milli AS log_time
FROM pieces""")
def log_parse_syslog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The structured syslog format (RFC 5424)."""
    line = F.concat(
        template("<{k}>1 {iso}+00:00 {host} app "),
        F.when(is_view(), "-").otherwise(F.col("user_id").cast("string")),
        template(" ID{k} "),
        F.when(is_signup(), "-").otherwise(template('[x@1 k="{k}"]')),
        template(" event {event_id}"),
    )
    return parsed(spark, sf_dir, "syslog-rfc5424", line)


@query(PIECES_SQL + """
SELECT k AS pri, bsd AS time, 'app-' || event_type AS ident,
  CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END AS pid,
  'event ' || event_id || ' done' AS message, second AS log_time
FROM pieces""")
def log_parse_syslog_rfc3164_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(
        template("<{k}>{bsd} app-{event_type}"), F.when(is_view(), "").otherwise(template("[{user_id}]")),
        template(": event {event_id} done"),
    )
    return parsed(spark, sf_dir, "syslog-rfc3164-local", line)


@query(PIECES_SQL + """
SELECT k AS pri, bsd AS time, host, 'app-' || event_type AS ident,
  CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END AS pid,
  'event ' || event_id || ' done' AS message, second AS log_time
FROM pieces""")
def log_parse_syslog_rfc3164(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(
        template("<{k}>{bsd} {host} app-{event_type}"),
        F.when(is_view(), "").otherwise(template("[{user_id}]")), template(": event {event_id} done"),
    )
    return parsed(spark, sf_dir, "syslog-rfc3164", line)


@query(PIECES_SQL + """
SELECT iso || 'Z' AS time, 'I' AS severity, 'COMMAND' AS component, 'conn' || user_id AS context,
  'event ' || event_type || ' of e' || event_id || '.' AS message,
  CASE WHEN event_type <> 'view' THEN k END AS ms, milli AS log_time
FROM pieces""")
def log_parse_mongodb(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(
        template("{iso}Z I COMMAND  [conn{user_id}] event {event_type} of e{event_id}."),
        F.when(is_view(), "").otherwise(template(" {k}ms")),
    )
    return parsed(spark, sf_dir, "mongodb", line)


@query(PIECES_SQL + """
SELECT iso || 'Z' AS start_time, CASE WHEN event_type = 'signup' THEN 'PING' ELSE 'GET' END AS method,
  CASE WHEN event_type <> 'signup' THEN path END AS path, 'HTTP/2' AS protocol, code,
  '-' AS response_flags, '0' AS bytes_received, size AS bytes_sent, k AS duration,
  '1' AS x_envoy_upstream_service_time, host AS x_forwarded_for, agent AS user_agent,
  'req ' || event_id AS request_id, 'site-' || user_id AS authority, host || ':80' AS upstream_host,
  milli AS log_time
FROM pieces""")
def log_parse_envoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(
        template("[{iso}Z] "),
        F.when(is_signup(), '"PING HTTP/2"').otherwise(template('"GET {path} HTTP/2"')),
        template(' {code} - 0 {size} {k} 1 "{host}" "{agent}" "req {event_id}" "site-{user_id}" "{host}:80"'),
    )
    return parsed(spark, sf_dir, "envoy", line)


@query(PIECES_SQL + """
SELECT iso || 'Z' AS start_time, CASE WHEN event_type = 'signup' THEN 'PING' ELSE 'GET' END AS method,
  CASE WHEN event_type <> 'signup' THEN path END AS path, 'HTTP/2' AS protocol, code AS response_code,
  '-' AS response_flags, 'via_upstream' AS response_code_details, '-' AS connection_termination_details,
  '"-"' AS upstream_transport_failure_reason, '0' AS bytes_received, size AS bytes_sent, k AS duration,
  '1' AS x_envoy_upstream_service_time, host AS x_forwarded_for, agent AS user_agent,
  'req ' || event_id AS x_request_id, '"site-' || user_id AS authority, host || ':80' AS upstream_host,
  'out|80||' || usr AS upstream_cluster, host || ':1' AS upstream_local_address,
  host || ':2' AS downstream_local_address, host || ':3' AS downstream_remote_address,
  'server-' || k AS requested_server_name, 'route-' || event_type AS route_name, milli AS log_time
FROM pieces""")
def log_parse_istio_envoy_proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pattern has no quote before the authority, so its opening quote belongs to the value."""
    line = F.concat(
        template("[{iso}Z] "),
        F.when(is_signup(), '"PING HTTP/2"').otherwise(template('"GET {path} HTTP/2"')),
        template(' {code} - via_upstream - "-" 0 {size} {k} 1 "{host}" "{agent}" "req {event_id}"'),
        template(' "site-{user_id}" "{host}:80" out|80||{usr} {host}:1 {host}:2 {host}:3'),
        template(" server-{k} route-{event_type}"),
    )
    return parsed(spark, sf_dir, "istio-envoy-proxy", line)


@query(PIECES_SQL + """
SELECT iso || 'Z' AS time, CASE WHEN event_type = 'error' THEN 'stderr' ELSE 'stdout' END AS stream,
  'F' AS logtag, 'event ' || event_id AS message, milli AS log_time
FROM pieces""")
def log_parse_cri(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = F.when(F.col("event_type") == "error", "stderr").otherwise("stdout")
    line = F.concat(template("{iso}Z "), stream, template(" F event {event_id}"))
    return parsed(spark, sf_dir, "cri", line)


@query(PIECES_SQL + """
SELECT 'kube' AS tag, 'var.log.containers.pod-' || user_id AS pod_name, 'ns-' || event_type AS namespace_name,
  'box-' || k AS container_name, md5(CAST(event_id AS VARCHAR)) || md5(CAST(event_id AS VARCHAR)) AS docker_id
FROM pieces""")
def log_parse_kube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag, pod, namespace, container and id from a log file's path."""
    line = template(
        "kube.var.log.containers.pod-{user_id}_ns-{event_type}_box-{k}-{digest}{digest}.log"
    )
    return parsed(spark, sf_dir, "kube-custom", line)


@query(PIECES_SQL + "SELECT event_type AS level, CAST(k AS INTEGER) AS k, second AS log_time FROM pieces")
def log_parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines; the time key becomes the record's time and is not kept."""
    line = template('{"level":"{event_type}","k":{k},"time":"{clf}"}')
    fields, _ = parse_json_log(lines(spark, sf_dir, line), "level string, k int, time string")
    timed = fields.withColumn("log_time", F.date_format(clf_timestamp("time"), TS_MILLIS))
    return timed.drop("time")


@query(PIECES_SQL + """
SELECT 'event ' || event_id AS log, 'stdout' AS stream, iso || 'Z' AS time, milli AS log_time FROM pieces""")
def log_parse_docker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container logs in JSON; the time key is kept."""
    line = template('{"log":"event {event_id}","stream":"stdout","time":"{iso}Z"}')
    fields, _ = parse_json_log(lines(spark, sf_dir, line), "log string, stream string, time string")
    return fields.withColumn("log_time", F.date_format(iso_timestamp("time"), TS_MILLIS))


@query("""
SELECT CASE WHEN event_type <> 'purchase' THEN event_type END AS level,
  CASE WHEN event_type <> 'purchase' THEN 'event ' || event_id || ' ok' END AS msg,
  CASE WHEN event_type <> 'purchase' THEN props::JSON->>'k' END AS k
FROM events""")
def log_parse_logfmt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of key and value, quoted or not; a line without pairs gives NULLs."""
    line = template('level={event_type} msg="event {event_id} ok" k={k}')
    return lines(spark, sf_dir, line).select(*logfmt_fields("value", ["level", "msg", "k"]))


@query("SELECT 'sold,' || event_id AS value FROM events WHERE event_type = 'purchase'")
def log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that a parser does not match, unchanged."""
    line = template("{iso}Z stdout F event {event_id}")
    return parse_log(lines(spark, sf_dir, line), "cri")[1]
