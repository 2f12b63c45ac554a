"""Registered queries vs their DuckDB SQL at sf0.001 (the driver gate runs sf0.01)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import digest

FAST = sorted(q for q in E.oracle_sql() if q.startswith("q"))


def test_every_query_registered():
    qs = E.queries()
    assert len(qs) >= 38
    assert set(E.oracle_sql()) <= set(qs)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    o = duck.sql(E.oracle_sql()[name])
    orows = o.fetchall()
    assert sorted(df.columns) == sorted(o.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(o.columns, orows)[0]


def test_entry_flagship_counts(spark):
    df = E.entry(spark)
    assert df.count() == 90  # FIXTURES section 3


@pytest.mark.parametrize("name", ["q01_parse", "q17_dedup", "q21_calendar", "q30_alerts"])
def test_results_do_not_depend_on_session_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    o = duck.sql(E.oracle_sql()[name])
    assert digest(df.columns, rows)[0] == digest(o.columns, o.fetchall())[0]
