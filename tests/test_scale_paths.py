"""The large-input plans (no broadcasts, range-partitioned global windows)
give the same results as the oracle."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tillstar.oracle.compare import same_result
from tillstar.plans.registry import view_functions
from tillstar.plans.warehouse import build_warehouse
from tillstar.sources.staging import stage_raw_sales

SF = "/root/testdata/sf0.001"
FORCED = {"tillstar.broadcast.maxRows": "0",
          "tillstar.window.rowsPerRange": "300", "spark.sql.autoBroadcastJoinThreshold": "-1",
          "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
NAMES = ["fact_sales", "dim_customer", "kpi_monthly_revenue", "kpi_profit_by_category", "rfm_segments",
         "customer_clv", "top_customers", "customer_pareto", "cohort_retention", "mkt_channel_new_vs_returning",
         "win_product_row_number", "win_product_quartiles", "win_customer_leaderboard", "exec_top_customers",
         "rfm_quantile", "pareto_point", "dq_numeric_summary", "outliers_iqr", "referential_integrity",
         "surrogate_keys"]


@pytest.fixture(scope="module")
def forced_wh(spark):
    old = {k: spark.conf.get(k, None) for k in FORCED}
    for k, v in FORCED.items():
        spark.conf.set(k, v)
    wh = build_warehouse(spark, stage_raw_sales(spark, SF))
    yield wh
    wh.release()
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["nation", "customer", "part", "orders", "lineitem"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


def test_fact_spread_over_ranges(forced_wh):
    assert forced_wh.fact.rdd.getNumPartitions() > 1


@pytest.mark.parametrize("name", NAMES)
def test_forced_large_paths_match_oracle(spark, forced_wh, con, name):
    for k, v in FORCED.items():
        spark.conf.set(k, v)
    sdf = view_functions()[name](forced_wh)
    res = con.execute(E.oracle_sql()[name])
    ok, msg = same_result(sdf.columns, [tuple(r) for r in sdf.collect()], [d[0] for d in res.description],
                          res.fetchall())
    assert ok, msg
