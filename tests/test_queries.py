"""Every registered query at the smallest scale, against its SQL where it has one."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from tools.check_queries import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, con, name):
    df = driver.queries()[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    assert got[1]
    if name in driver.oracle_sql():
        cur = con.execute(driver.oracle_sql()[name])
        assert got == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_filters_and_columns_reach_the_scan(spark, plan):
    text = plan(driver.queries()["keyword_dates"](spark, SF))
    assert "GreaterThanOrEqual(ts" in text and "value" not in text.split("ReadSchema")[1]
    for name in ("q_causes", "q_entity_cause", "dedup_best", "upsert_star", "cache_miss", "dup_text_flag"):
        text = plan(driver.queries()[name](spark, SF))
        assert "Cartesian" not in text and "NestedLoop" not in text, name


def test_hot_keys_are_reduced_before_the_shuffle(spark, plan):
    """Reading a plan bottom-up, something must shrink each group before the exchange."""
    for name, reducer in (("dedup_best", "partial_min_by"), ("last_per_id", "partial_max_by"), ("search_topk", "WindowGroupLimit"),
                          ("posts_per_cause", "partial_count")):
        assert reducer in plan(driver.queries()[name](spark, SF)), name
