"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os

import duckdb
import pytest

import __spark_entry__ as ENTRY
from chanmart.plans.oracle import ORACLE_SQL
from chanmart.plans.registered import QUERIES
from tools.compare_oracle import TABLES, _rows

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    df = ENTRY.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(ENTRY.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, s_rows) == _rows(d_cols, d_rows)


def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    assert df.columns == ["product_name", "mention_count"]
    assert df.count() == 10


@pytest.mark.parametrize(
    "name", ["stg_messages", "dim_dates", "fct_messages", "channel_activity", "photo_worklist", "append_new_messages"]
)
def test_results_do_not_depend_on_session_zone_or_ansi(spark, con, name):
    from chanmart.session import session_conf

    with session_conf(spark, {"spark.sql.session.timeZone": "America/Los_Angeles", "spark.sql.ansi.enabled": "false"}):
        df = ENTRY.queries()[name](spark, SF)
        s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(ENTRY.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    assert _rows(df.columns, s_rows) == _rows(d_cols, res.fetchall())
