"""Every catalogue query against its DuckDB SQL."""

import datetime

import duckdb
import pytest

from tagflow.plans import catalogue

TABLES = ["events", "orders", "pages", "customer"]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(x):
    return x.replace(tzinfo=None) if isinstance(x, datetime.datetime) else x


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_same_rows(spark, sf, duck, name):
    df = catalogue.queries()[name](spark, sf)
    found = duck.execute(catalogue.SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    want = sorted([tuple(plain(r[columns.index(c)]) for c in order) for r in found.fetchall()], key=str)
    assert sorted([tuple(plain(r[c]) for c in order) for r in df.collect()], key=str) == want


def test_stream_keeps_one_row_for_each_delivery_inside_the_delay(spark, sf):
    rows = catalogue.queries()["stream_dedup_within_watermark"](spark, sf).count()
    whole = catalogue.journal(spark, sf).where("record_type = 'UPDATE_METADATA'").count()
    assert 0 < rows < whole


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 10
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_window_is_pushed_to_the_scan(spark, sf):
    plan = catalogue.ops(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts" in plan
