"""Every report on the star gives the same on a star written and opened again."""

from __future__ import annotations

import duckdb
import pytest

from tillstar.oracle.compare import same_result
from tillstar.plans import customer, executive, kpi, marketing, notebook, windows
from tillstar.plans.registry import oracle_sql
from tillstar.plans.star_reports import stored_tables
from tillstar.plans.warehouse import open_warehouse, warehouse_for
from tillstar.session import scratch_path
from tillstar.sources import sinks

SF = "/root/testdata/sf0.001"
VIEWS = {name: view for m in (kpi, customer, marketing, windows, executive, notebook) for name, view in m.VIEWS.items()}


@pytest.fixture(scope="module")
def stored(spark):
    base = scratch_path(spark, "stored")
    sinks.write_warehouse(stored_tables(warehouse_for(spark, SF)), base)
    return open_warehouse(spark, base)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_report(stored, con, name):
    assert_same(VIEWS[name](stored), con.execute(oracle_sql()[name]))


def assert_same(df, cursor):
    ok, why = same_result(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in cursor.description],
                          cursor.fetchall())
    assert ok, why


def test_segments_are_stored(stored):
    assert stored.dim_customer.filter("customer_segment IS NULL").count() == 0
