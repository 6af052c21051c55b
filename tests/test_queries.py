"""The register: every query has an oracle, and results match on small data."""
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, canonical

SMALL = "/root/testdata/sf0.001"


def test_every_market_query_has_an_oracle():
    own = {n for n in entry.queries() if n != "pipeline" and not re.match(r"op\d+_", n)}  # the rest is an optional part
    assert own <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ["compose_bars", "split_adjust", "daily_rank", "excursions", "earnings_reaction",
                                  "quality_flags", "universe_refresh", "option_chain_label"])
def test_small_data_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = entry.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert canonical(rows, df.columns) == canonical(cur.fetchall(), names)


@pytest.mark.parametrize("name", ["rank_score", "quality_flags", "earnings_reaction", "leave_one_out_benchmark"])
def test_a_supplier_with_a_third_of_all_lines(spark, tmp_path, name):
    """Moving a third of the lines (and of the orders) to one key changes no rule."""
    con = duckdb.connect()
    folder = "/root/testdata/sf0.01"
    for t in TABLES:
        con.execute(f"COPY (SELECT * FROM '{folder}/{t}.parquet') TO '{tmp_path}/{t}.parquet'")
    con.execute(f"COPY (SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END AS l_suppkey) FROM '{folder}/lineitem.parquet') TO '{tmp_path}/lineitem.parquet'")
    con.execute(f"COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS o_custkey) FROM '{folder}/orders.parquet') TO '{tmp_path}/orders.parquet'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    df = entry.queries()[name](spark, str(tmp_path))
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert canonical(rows, df.columns) == canonical(cur.fetchall(), names)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_stored_series_are_composed_where_they_lie(spark):
    """From the buckets to the indicators nothing is exchanged."""
    from barloom.operators.indicators import latest_indicators
    from workload import prices
    from workload.stores import stored_bars
    folder = "/root/testdata/sf0.001"
    rows = latest_indicators(stored_bars(spark, folder))
    got = sorted(map(tuple, rows.collect()), key=str)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert got == sorted(map(tuple, latest_indicators(prices.composed(spark, folder)).collect()), key=str)
