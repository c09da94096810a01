"""Bulk parsing of log lines in well-known formats.

Each regular expression runs once per line: it is replaced by its groups, parted by a separator,
and split. Lines that do not match go to a reject table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The log formats' patterns and time formats. A pattern's enclosing slashes, which are
# no part of the expression, are left off.
LOG_PATTERNS = {
    "apache": r'^(?<host>[^ ]*) [^ ]* (?<user>[^ ]*) \[(?<time>[^\]]*)\] "(?<method>\S+)(?: +(?<path>[^\"]*?)(?: +\S*)?)?" (?<code>[^ ]*) (?<size>[^ ]*)(?: "(?<referer>[^\"]*)" "(?<agent>[^\"]*)")?$',
    "apache2": r'^(?<host>[^ ]*) [^ ]* (?<user>[^ ]*) \[(?<time>[^\]]*)\] "(?<method>\S+)(?: +(?<path>[^ ]*) +\S*)?" (?<code>[^ ]*) (?<size>[^ ]*)(?: "(?<referer>[^\"]*)" "(?<agent>.*)")?$',
    "apache_error": r'^\[[^ ]* (?<time>[^\]]*)\] \[(?<level>[^\]]*)\](?: \[pid (?<pid>[^\]]*)\])?( \[client (?<client>[^\]]*)\])? (?<message>.*)$',
    "nginx": r'^(?<remote>[^ ]*) (?<host>[^ ]*) (?<user>[^ ]*) \[(?<time>[^\]]*)\] "(?<method>\S+)(?: +(?<path>[^\"]*?)(?: +\S*)?)?" (?<code>[^ ]*) (?<size>[^ ]*)(?: "(?<referer>[^\"]*)" "(?<agent>[^\"]*)")',
    "k8s-nginx-ingress": r'^(?<host>[^ ]*) - (?<user>[^ ]*) \[(?<time>[^\]]*)\] "(?<method>\S+)(?: +(?<path>[^\"]*?)(?: +\S*)?)?" (?<code>[^ ]*) (?<size>[^ ]*) "(?<referer>[^\"]*)" "(?<agent>[^\"]*)" (?<request_length>[^ ]*) (?<request_time>[^ ]*) \[(?<proxy_upstream_name>[^ ]*)\] (\[(?<proxy_alternative_upstream_name>[^ ]*)\] )?(?<upstream_addr>[^ ]*) (?<upstream_response_length>[^ ]*) (?<upstream_response_time>[^ ]*) (?<upstream_status>[^ ]*) (?<reg_id>[^ ]*).*$',
    "docker-daemon": r'time="(?<time>[^ ]*)" level=(?<level>[^ ]*) msg="(?<msg>[^ ].*)"',
    "syslog-rfc5424": r'^\<(?<pri>[0-9]{1,5})\>1 (?<time>[^ ]+) (?<host>[^ ]+) (?<ident>[^ ]+) (?<pid>[-0-9]+) (?<msgid>[^ ]+) (?<extradata>(\[(.*?)\]|-)) (?<message>.+)$',
    "syslog-rfc3164-local": r'^\<(?<pri>[0-9]+)\>(?<time>[^ ]* {1,2}[^ ]* [^ ]*) (?<ident>[a-zA-Z0-9_\/\.\-]*)(?:\[(?<pid>[0-9]+)\])?(?:[^\:]*\:)? *(?<message>.*)$',
    "syslog-rfc3164": r'^\<(?<pri>[0-9]+)\>(?<time>[^ ]* {1,2}[^ ]* [^ ]*) (?<host>[^ ]*) (?<ident>[a-zA-Z0-9_\/\.\-]*)(?:\[(?<pid>[0-9]+)\])?(?:[^\:]*\:)? *(?<message>.*)$',
    "mongodb": r'^(?<time>[^ ]*)\s+(?<severity>\w)\s+(?<component>[^ ]+)\s+\[(?<context>[^\]]+)]\s+(?<message>.*?) *(?<ms>(\d+))?(:?ms)?$',
    "envoy": r'^\[(?<start_time>[^\]]*)\] "(?<method>\S+)(?: +(?<path>[^\"]*?)(?: +\S*)?)? (?<protocol>\S+)" (?<code>[^ ]*) (?<response_flags>[^ ]*) (?<bytes_received>[^ ]*) (?<bytes_sent>[^ ]*) (?<duration>[^ ]*) (?<x_envoy_upstream_service_time>[^ ]*) "(?<x_forwarded_for>[^ ]*)" "(?<user_agent>[^\"]*)" "(?<request_id>[^\"]*)" "(?<authority>[^ ]*)" "(?<upstream_host>[^ ]*)"',
    "istio-envoy-proxy": r'^\[(?<start_time>[^\]]*)\] "(?<method>\S+)(?: +(?<path>[^\"]*?)(?: +\S*)?)? (?<protocol>\S+)" (?<response_code>[^ ]*) (?<response_flags>[^ ]*) (?<response_code_details>[^ ]*) (?<connection_termination_details>[^ ]*) (?<upstream_transport_failure_reason>[^ ]*) (?<bytes_received>[^ ]*) (?<bytes_sent>[^ ]*) (?<duration>[^ ]*) (?<x_envoy_upstream_service_time>[^ ]*) "(?<x_forwarded_for>[^ ]*)" "(?<user_agent>[^\"]*)" "(?<x_request_id>[^\"]*)" (?<authority>[^ ]*)" "(?<upstream_host>[^ ]*)" (?<upstream_cluster>[^ ]*) (?<upstream_local_address>[^ ]*) (?<downstream_local_address>[^ ]*) (?<downstream_remote_address>[^ ]*) (?<requested_server_name>[^ ]*) (?<route_name>[^  ]*)',
    "cri": r'^(?<time>[^ ]+) (?<stream>stdout|stderr) (?<logtag>[^ ]*) (?<message>.*)$',
    "kube-custom": r'(?<tag>[^.]+)?\.?(?<pod_name>[a-z0-9](?:[-a-z0-9]*[a-z0-9])?(?:\.[a-z0-9]([-a-z0-9]*[a-z0-9])?)*)_(?<namespace_name>[^_]+)_(?<container_name>.+)-(?<docker_id>[a-z0-9]{64})\.log$',
}
CLF_TIME = "dd/MMM/yyyy:HH:mm:ss Z"
SYSLOG_TIME = "yyyy MMM d HH:mm:ss"
# Formats whose time has a pattern of its own; the others are ISO 8601 or keep the text only.
TIME_PATTERNS = {
    "apache": CLF_TIME,
    "apache2": CLF_TIME,
    "nginx": CLF_TIME,
    "k8s-nginx-ingress": CLF_TIME,
    "syslog-rfc3164-local": SYSLOG_TIME,
    "syslog-rfc3164": SYSLOG_TIME,
}
ISO_TIMES = {
    "docker-daemon": "time",
    "syslog-rfc5424": "time",
    "mongodb": "time",
    "envoy": "start_time",
    "istio-envoy-proxy": "start_time",
    "cri": "time",
}
# The keys of a container's JSON log.
DOCKER_FIELDS = "log string, stream string, time string"
LOGFMT_PAIR = r'([^\s=]+)=("[^"]*"|\S*)'

# Cheap conditions that every matching line meets. A pattern that backtracks for long on other lines is
# run only where they hold.
NECESSARY = {"kube-custom": r"-[a-z0-9]{64}\.log$"}
SEPARATOR = "\u0001"


@dataclass(frozen=True)
class LogFormat:
    """A pattern without group names, and each field's group number."""

    pattern: str
    groups: int
    fields: dict[str, int]


def log_format(name: str) -> LogFormat:
    """Number the named groups of a pattern. Java allows no ``_`` in names, so they are taken out."""
    named = LOG_PATTERNS[name]
    opening = re.compile(r"\\.|\[(?:\\.|[^\]\\])*\]|\(\?<(\w+)>|\((?!\?)")
    fields: dict[str, int] = {}
    groups = 0
    for found in opening.finditer(named):
        if found.group(0).startswith("("):
            groups += 1
            if found.group(1):
                fields[found.group(1)] = groups
    return LogFormat(re.sub(r"\(\?<\w+>", "(", named), groups, fields)


def group_values(line: Column, fmt: LogFormat) -> Column:
    """The values of all groups as an array; another length when the line does not match."""
    around = rf"^[\s\S]*?(?:{fmt.pattern})[\s\S]*$"
    groups = SEPARATOR.join(f"${number}" for number in range(1, fmt.groups + 1))
    by_split = F.split(F.regexp_replace(line, around, groups), SEPARATOR, -1)
    # A line that holds the separator itself is parsed group by group.
    by_group = F.when(
        F.regexp_like(line, F.lit(fmt.pattern)),
        F.array(*[F.regexp_extract(line, fmt.pattern, g) for g in range(1, fmt.groups + 1)]),
    )
    return F.when(F.contains(line, F.lit(SEPARATOR)), by_group).otherwise(by_split)


def matched_log(lines: DataFrame, name: str, value: str = "value") -> DataFrame:
    """Each line with ``matched`` and its ``fields`` as text, in one pass over the lines.

    A field that is empty, or whose optional part is missing, is NULL. The generator keeps the
    optimizer from copying the regular expression into every field.
    """
    if name == "logfmt":
        raise ValueError("logfmt has no fixed fields: use matched_logfmt")
    fmt = log_format(name)
    values = group_values(F.col(value), fmt)
    if name in NECESSARY:
        values = F.when(F.regexp_like(value, F.lit(NECESSARY[name])), values)
    grouped = lines.select(value, F.explode(F.array(values)).alias("groups"))
    matches = F.coalesce(F.size("groups") == fmt.groups, F.lit(False))
    fields = [
        F.nullif(F.get("groups", F.lit(number - 1)), F.lit("")).alias(field)
        for field, number in fmt.fields.items()
    ]
    return grouped.select(value, matches.alias("matched"), F.when(matches, F.struct(*fields)).alias("fields"))


def parse_log(lines: DataFrame, name: str, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """The matching lines' fields, and the lines that do not match; ``matched_log`` gives both in one pass."""
    both = matched_log(lines, name, value)
    return both.filter("matched").select("fields.*"), both.filter("not matched").select(value)


def matched_logfmt(lines: DataFrame, names: list[str], value: str = "value") -> DataFrame:
    """As ``matched_log``, for ``key=value`` lines; a line without any pair does not match."""
    matches = F.coalesce(F.regexp_like(value, F.lit(LOGFMT_PAIR)), F.lit(False))
    fields = F.struct(*logfmt_fields(value, names))
    return lines.select(value, matches.alias("matched"), F.when(matches, fields).alias("fields"))


def clf_timestamp(text: Column | str) -> Column:
    """Time of an access log line."""
    return F.try_to_timestamp(text, F.lit(CLF_TIME))


def iso_timestamp(text: Column | str) -> Column:
    """ISO 8601 time with or without a fraction and an offset."""
    return F.try_to_timestamp(text)


def syslog_timestamp(text: Column, year: Column | int | None = None) -> Column:
    """Time of a classic syslog line. It names no year; the current one is taken unless given."""
    if year is None:
        year = F.year(F.current_date())
    elif isinstance(year, int):
        year = F.lit(year)
    return F.try_to_timestamp(
        F.concat_ws(" ", year.cast("string"), F.regexp_replace(text, " +", " ")), F.lit(SYSLOG_TIME)
    )


def with_log_time(fields: DataFrame, name: str, year: int | None = None) -> DataFrame:
    """Add ``log_time`` for the formats that define a time."""
    pattern = TIME_PATTERNS.get(name)
    if pattern == CLF_TIME:
        return fields.withColumn("log_time", clf_timestamp("time"))
    if pattern == SYSLOG_TIME:
        return fields.withColumn("log_time", syslog_timestamp(F.col("time"), year))
    if name in ISO_TIMES:
        return fields.withColumn("log_time", iso_timestamp(ISO_TIMES[name]))
    return fields


def matched_json_log(lines: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """As ``matched_log``, for JSON lines with a declared schema; a line that is no JSON object does not match."""
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    parsed = F.when(F.regexp_like(value, F.lit(r"^\s*\{")), F.from_json(value, f"{schema}, _corrupt string", options))
    both = lines.select(value, parsed.alias("parsed"))
    matches = F.col("parsed").isNotNull() & F.col("parsed._corrupt").isNull()
    return both.select(value, matches.alias("matched"), F.when(matches, F.col("parsed").dropFields("_corrupt")).alias("fields"))


def parse_json_log(lines: DataFrame, schema: str, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """The fields of JSON lines, and the lines that are no JSON object; ``matched_json_log`` gives both in one pass."""
    both = matched_json_log(lines, schema, value)
    return both.filter("matched").select("fields.*"), both.filter("not matched").select(value)


def logfmt_fields(line: Column | str, names: list[str]) -> list[Column]:
    """The named ``key=value`` fields of a line, quotes taken off; the last one wins, absent is NULL."""
    keys = F.regexp_extract_all(line, F.lit(LOGFMT_PAIR), F.lit(1))
    values = F.regexp_extract_all(line, F.lit(LOGFMT_PAIR), F.lit(2))
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))

    def pick(name: str) -> Column:
        found = F.filter(pairs, lambda pair: pair["k"] == name)
        text = F.try_element_at(found, F.lit(-1))["v"]
        return F.regexp_replace(text, '^"([^"]*)"$', "$1").alias(name)

    return [pick(name) for name in names]
