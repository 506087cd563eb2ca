"""A hot key (one customer, product and day holding a third of all orders)
gives the same results on the small-input and the large-input plans."""

import datetime as dt
import random

import pytest

from tests.fixtures import make_raw
from tillstar.plans.registry import view_functions
from tillstar.plans.warehouse import build_warehouse

FORCED = {"tillstar.broadcast.maxRows": "0",
          "tillstar.window.rowsPerRange": "40", "spark.sql.autoBroadcastJoinThreshold": "-1",
          "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
VIEWS = ["kpi_monthly_revenue", "rfm_segments", "customer_clv", "top_customers", "customer_pareto",
         "win_product_row_number", "win_product_quartiles", "win_customer_leaderboard", "cohort_retention",
         "mkt_channel_new_vs_returning", "rfm_quantile", "pareto_point", "dq_numeric_summary", "fact_sales"]


def skewed_rows(n=300):
    rnd = random.Random(11)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        rows.append(dict(
            customer_id=1 if hot else rnd.randint(2, 60),
            product_id=1 if hot else rnd.randint(2, 40),
            product_category="Hot" if hot else rnd.choice(["A", "B", "C"]),
            order_date=dt.date(2024, 5, 5) if hot else dt.date(2023, 1, 1) + dt.timedelta(days=rnd.randint(0, 600)),
            product_price=str(rnd.choice([10, 20, 35, 50, 80])) + ".00",
            discount_percent=str(rnd.choice([0, 5, 10, 25, 40])),
            quantity=rnd.randint(1, 4), rating=None if rnd.random() < 0.1 else str(rnd.choice([1.0, 2.5, 4.0, 5.0])),
            is_returned=int(rnd.random() < 0.2)))
    return rows


@pytest.fixture(scope="module")
def both(spark):
    raw = make_raw(spark, skewed_rows())
    small = build_warehouse(spark, raw)
    old = {k: spark.conf.get(k, None) for k in FORCED}
    for k, v in FORCED.items():
        spark.conf.set(k, v)
    large = build_warehouse(spark, raw)
    out = {}
    views = view_functions()
    for name in VIEWS:
        out[name] = sorted(tuple(r) for r in views[name](large).collect())
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)
    for name in VIEWS:
        out[name] = (sorted(tuple(r) for r in views[name](small).collect()), out[name])
    small.release()
    large.release()
    return out


@pytest.mark.parametrize("name", VIEWS)
def test_hot_keys_same_result_on_both_plans(both, name):
    small, large = both[name]
    assert small == large
    assert len(small) > 0
