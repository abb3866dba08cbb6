"""Every registered query against its DuckDB oracle at sf0.001, plus the entry point."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans import registry
from tests.conftest import SF_SMALL

TABLES = ["customer", "orders", "events", "lineitem", "supplier", "part", "nation"]
_DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
               "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert "rank" in df.columns and df.count() >= 0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL oracle")
    res = duck.sql(sql)
    assert sorted(df.columns) == sorted(res.columns)
    duck_types = dict(zip(res.columns, [str(t).replace(" ", "") for t in res.types]))
    for f in df.schema.fields:  # types line up too, not only names
        t = f.dataType.simpleString()
        assert duck_types[f.name] == (t.upper() if t.startswith("decimal") else _DUCK_TYPES.get(t, t)), f.name
    assert _bag(df.columns, rows) == _bag(res.columns, res.fetchall())


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", ["priority_rank", "staleness_tiers", "event_time_format", "event_time_parse",
                                  "load_report", "history_after_complete"])
def test_results_do_not_depend_on_session_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.sql(E.oracle_sql()[name])
    assert _bag(df.columns, rows) == _bag(res.columns, res.fetchall())


def test_stored_control_fixtures_equal_lazy_ones(spark):
    from tidemark.plans.fixtures import Fixtures
    lazy, stored = Fixtures(spark, SF_SMALL), Fixtures(spark, SF_SMALL, store_control=True)
    for name in ("attrs", "queue", "history"):
        a, b = getattr(lazy, name), getattr(stored, name)
        assert a.schema.simpleString() == b.schema.simpleString()
        assert _bag(a.columns, a.collect()) == _bag(b.columns, b.collect())

