"""Registered queries against their SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from tests.conftest import SMALL

from decisionlake.plans.catalog import QUERIES
from decisionlake.plans.oracles import SQL

FITTED = {"behavior_propensity", "reward_model_ridge", "reward_model_gbt", "cross_fit_behavior", "cross_fit_estimates",
          "behavior_report", "reward_model_report", "reward_model_comparison"}


# The smallest train split has fewer patients than folds.
LARGER = {"cross_fit_facts": "/root/testdata/sf0.01", "cross_fit_certificates": "/root/testdata/sf0.01",
          "end_to_end_facts": "/root/testdata/sf0.01"}


def connected(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="module")
def duck():
    return {folder: connected(folder) for folder in {SMALL, *LARGER.values()}}


def rounded(value):
    return round(value, 6) + 0.0 if isinstance(value, float) else value


def in_order(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
    assert not any("crossJoin" in open(f).read() for f in glob.glob("decisionlake/**/*.py", recursive=True))


def test_the_driver_has_every_query():
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    folder = LARGER.get(name, SMALL)
    df = QUERIES[name](spark, folder)
    names = sorted(df.columns)
    result = duck[folder].execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    want = [tuple(rounded(row[columns.index(c)]) for c in names) for row in result.fetchall()]
    got = [tuple(rounded(row[c]) for c in names) for row in df.collect()]
    assert in_order(got) == in_order(want)


def test_only_fitted_queries_lack_sql():
    assert set(QUERIES) - set(SQL) == FITTED


@pytest.mark.parametrize("name", ["behavior_propensity", "reward_model_ridge"])
def test_fitted_queries_run(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
