"""Every query with SQL gives the SQL's rows; the others give rows; the entry contract holds."""

import os

import pytest
from oracle import connect, differences

import __spark_entry__ as entry_module

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["window_start", "window_end", "distinct_macs", "approx_people"]
    assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF), connection, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_queries_leave_the_session_alone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        iso = QUERIES["ts_iso"](spark, SF).orderBy("event_id").first()["iso"]
        assert iso.endswith("+0000")
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
