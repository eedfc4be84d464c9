"""Business operators: oracle comparison at sf0.001 and properties of the
operators without SQL (grouped folds, routes, models)."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from marketlens.plans import fulfilment
from marketlens.sources.tables import load_tables
from oracle import basics as oracle_basics

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = ["q07_monthly_orders_revenue", "q09_price_revenue_by_state", "c01_label_churn", "c11_rfm",
          "m04_cap_roi", "b03_stock_ledger", "i09_understocked", "p03_elasticity", "o05_select_deliveries",
          "o13_route_distance", "a04_status_priority_crosstab", "r02_clean_reviews", "r08_top_ngrams",
          "r16_count_features", "r17_tfidf_features"]


def _norm(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, float):
        return f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE + sorted(oracle_basics.SQL))
def test_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF).toPandas()
    du = con.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(sp.columns) == sorted(du.columns)
    cols = sorted(sp.columns)
    a = sorted(tuple(_norm(x) for x in r) for r in sp[cols].itertuples(index=False))
    b = sorted(tuple(_norm(x) for x in r) for r in du[cols].astype(object).itertuples(index=False))
    assert len(a) == len(b)
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0


def test_every_query_has_an_id_and_runs_lazily(spark):
    qs = E.queries()
    assert len(qs) > 100
    sql = E.oracle_sql()
    assert set(sql) <= set(qs)


def test_each_warehouse_has_its_own_deliveries(spark):
    t = load_tables(spark, "/root/testdata/sf0.01")
    have = {r["warehouse_id"] for r in fulfilment.delivery_deadlines(t).select("warehouse_id").distinct().collect()}
    got = fulfilment.select_deliveries(t).groupBy("warehouse_id").count().collect()
    assert {r["warehouse_id"] for r in got} == have
    assert max(r["count"] for r in got) <= 36


def test_oracle_needs_no_spark_jars(monkeypatch, tmp_path):
    import pyspark
    monkeypatch.setattr(pyspark, "__file__", str(tmp_path / "pyspark" / "__init__.py"))
    assert len(E.oracle_sql()) > 100
