"""Log formats: groups, rejects and odd lines."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from roompulse.functions.logs import (
    LOG_PATTERNS, SEPARATOR, iso_timestamp, log_format, logfmt_fields, parse_json_log, parse_log,
    syslog_timestamp, with_log_time,
)


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


@pytest.mark.parametrize(
    ("name", "groups", "field", "number"),
    [
        ("apache_error", 6, "message", 6),
        ("syslog-rfc5424", 10, "message", 10),
        ("k8s-nginx-ingress", 19, "reg_id", 19),
        ("kube-custom", 6, "docker_id", 6),
        ("istio-envoy-proxy", 24, "route_name", 24),
    ],
)
def test_unnamed_groups_are_counted(name, groups, field, number):
    fmt = log_format(name)
    assert (fmt.groups, fmt.fields[field]) == (groups, number)


@pytest.mark.parametrize("name", sorted(LOG_PATTERNS))
def test_no_line_is_lost(spark, name):
    odd = lines(spark, "", "x", None, f"a{SEPARATOR}b", "\\ $1 {}")
    parsed, rejected = parse_log(odd, name)
    assert parsed.count() + rejected.count() == 5


def test_separator_inside_a_line(spark):
    text = f"2024-01-01T00:00:00Z stdout F one{SEPARATOR}two"
    parsed, rejected = parse_log(lines(spark, text, f"bad{SEPARATOR}line"), "cri")
    assert [r["message"] for r in parsed.collect()] == [f"one{SEPARATOR}two"]
    assert [r["value"] for r in rejected.collect()] == [f"bad{SEPARATOR}line"]


def test_dollars_and_backslashes_survive(spark):
    text = r"2024-01-01T00:00:00Z stderr P cost $1 \d {x}"
    assert parse_log(lines(spark, text), "cri")[0].first()["message"] == r"cost $1 \d {x}"


def test_pattern_may_match_inside_the_line(spark):
    text = 'noise time="2024-01-01T00:00:00.5Z" level=info msg="hi there" more'
    row = with_log_time(parse_log(lines(spark, text), "docker-daemon")[0], "docker-daemon").first()
    assert (row["level"], row["msg"]) == ("info", "hi there")
    assert row["log_time"] is not None


def test_one_regular_expression_pass(spark):
    parsed, _ = parse_log(lines(spark, "x"), "istio-envoy-proxy")
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(") == 1


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-01-01T00:00:07.179", "2024-01-01 00:00:07.179"),
        ("2024-01-01T00:00:07.179Z", "2024-01-01 00:00:07.179"),
        ("2024-01-01T02:00:07.179+02:00", "2024-01-01 00:00:07.179"),
        ("2024-01-01T02:00:07.179+0200", "2024-01-01 00:00:07.179"),
        ("yesterday", None),
    ],
)
def test_iso_times(spark, text, expected):
    row = lines(spark, text).select(F.date_format(iso_timestamp("value"), "yyyy-MM-dd HH:mm:ss.SSS")).first()
    assert row[0] == expected


def test_syslog_time(spark):
    row = lines(spark, "Feb  9 01:02:03").select(
        syslog_timestamp(F.col("value"), 2024).alias("t"), syslog_timestamp(F.col("value")).alias("now")
    ).first()
    assert row["t"] == dt.datetime(2024, 2, 9, 1, 2, 3)
    assert row["now"].month == 2


def test_json_logs(spark):
    good = '{"log":"a","stream":"stdout","time":"2024-01-01T00:00:00.1Z"}'
    parsed, rejected = parse_json_log(
        lines(spark, good, "null", "", "{bad", "[1]", None), "log string, stream string, time string"
    )
    assert [r["log"] for r in parsed.collect()] == ["a"]
    assert parsed.columns == ["log", "stream", "time"]
    assert rejected.count() == 5


def test_logfmt(spark):
    df = lines(spark, 'level=info msg="two words" k= level=warn', "nothing here", 'msg=""')
    rows = df.select(*logfmt_fields("value", ["level", "msg", "k", "absent"])).collect()
    assert [tuple(r) for r in rows] == [
        ("warn", "two words", "", None), (None, None, None, None), (None, "", None, None)
    ]


SAMPLES = {
    "apache": '10.0.0.1 - ann [01/Jan/2024:00:00:07 +0000] "GET /a b HTTP/1.1" 200 12 "http://r" "agent x"',
    "apache2": '10.0.0.1 - ann [01/Jan/2024:00:00:07 +0000] "GET /a HTTP/1.1" 200 12 "http://r" "agent x"',
    "apache_error": "[Mon Jan 01 00:00:07 2024] [error] [pid 7] [client 10.0.0.1] no such file",
    "nginx": '10.0.0.1 host ann [01/Jan/2024:00:00:07 +0000] "GET /a HTTP/1.1" 200 12 "http://r" "agent"',
    "docker-daemon": 'x time="2024-01-01T00:00:07.1Z" level=info msg="hello there" y',
    "syslog-rfc5424": '<7>1 2024-01-01T00:00:07.1Z host app 17 ID4 [x@1 a="b"] some message',
    "syslog-rfc3164": "<7>Jan  1 00:00:07 host app[17]: some message",
    "syslog-rfc3164-local": "<7>Jan  1 00:00:07 app[17]: some message",
    "mongodb": "2024-01-01T00:00:07.1Z I COMMAND  [conn7] a command took 12ms",
    "cri": "2024-01-01T00:00:07.1Z stdout F some message",
    "kube-custom": f"kube.var.log.pod-1.a_ns_box-{'0f' * 32}.log",
}


@pytest.mark.parametrize("name", sorted(SAMPLES))
def test_one_pass_equals_group_by_group(spark, name):
    """Lines with deletions, doublings and swaps: the same match and the same groups."""
    rng = random.Random(name)
    texts = [SAMPLES[name]]
    for _ in range(150):
        text = list(rng.choice(texts[:20]))
        at = rng.randrange(len(text))
        change = rng.choice(["drop", "double", "swap", "space"])
        if change == "drop":
            del text[at]
        elif change == "double":
            text.insert(at, text[at])
        elif change == "swap":
            to = rng.randrange(len(text))
            text[at], text[to] = text[to], text[at]
        else:
            text.insert(at, rng.choice(' "[]-'))
        texts.append("".join(text))
    fmt = log_format(name)
    df = lines(spark, *texts)
    parsed = [tuple(r) for r in parse_log(df, name)[0].collect()]
    direct = df.filter(F.regexp_like("value", F.lit(fmt.pattern))).select(
        *[F.nullif(F.regexp_extract("value", fmt.pattern, g), F.lit("")) for g in fmt.fields.values()]
    )
    assert len(parsed) > 10
    assert sorted(parsed, key=str) == sorted([tuple(r) for r in direct.collect()], key=str)


def test_long_lines_are_rejected_at_once_as_kube_paths(spark):
    import time

    from roompulse.functions.logs import matched_log

    rows = [("x" * 20_000,), (" ".join(f"w{i}_" for i in range(20_000)),), ("a_b_" + "c" * 20_000 + ".log",), (None,), ("",),
            ("kube.var.log.pod-1_ns_box-" + "a" * 64 + ".log",)]
    begin = time.time()
    found = {r["value"]: r for r in matched_log(spark.createDataFrame(rows, "value string"), "kube-custom").collect()}
    assert time.time() - begin < 20
    assert [v for v, r in found.items() if r["matched"]] == [rows[-1][0]]
    assert found[rows[-1][0]]["fields"]["namespace_name"] == "ns"


def test_both_sides_of_logfmt(spark):
    from roompulse.functions.logs import matched_logfmt

    df = spark.createDataFrame([('a=1 b="x y"',), ("no pairs",), (None,)], "value string")
    rows = matched_logfmt(df, ["a", "b"]).collect()
    assert [(r["matched"], r["fields"] and tuple(r["fields"])) for r in rows] == [(True, ("1", "x y")), (False, None), (False, None)]
