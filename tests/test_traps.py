"""Semantic traps of the reference, one micro-fixture each."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.fixtures import make_raw
from tillstar.functions import mappings as mp
from tillstar.operators import quality as q
from tillstar.operators.dedup import dedup_keep_first
from tillstar.plans import customer, executive, kpi, marketing, notebook, windows
from tillstar.plans.warehouse import build_warehouse
from tillstar.schemas import INGEST_SEQ, RAW_COLUMNS

d = dt.date

pytestmark = pytest.mark.usefixtures("release_cache")


def rows_by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_rfm_direction(spark):
    # customer 1 is the most recent, most frequent and biggest spender
    rows = []
    for cust in range(1, 6):
        for k in range(6 - cust):
            rows.append(dict(customer_id=cust, order_date=d(2024, 6, 30 - cust * 3 - k),
                             product_price=str(100 * (6 - cust))))
    wh = build_warehouse(spark, make_raw(spark, rows))
    seg = rows_by(customer.rfm_segments(wh), "customer_id")
    assert (seg[1]["r_score"], seg[1]["f_score"], seg[1]["m_score"]) == (5, 5, 5)
    assert seg[1]["customer_segment"] == "Champions"
    assert (seg[5]["r_score"], seg[5]["f_score"], seg[5]["m_score"]) == (1, 1, 1)
    assert seg[5]["customer_segment"] == "Hibernating"


def test_rfm_segment_rules_first_match(spark):
    df = spark.createDataFrame([(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)],
                               "r int, f int, m int")
    out = df.withColumn("s", mp.rfm_segment(F.col("r"), F.col("f"), F.col("m"))).collect()
    got = {(x.r, x.f, x.m): x.s for x in out}
    assert got[(5, 5, 5)] == "Champions" and got[(3, 3, 3)] == "Loyal Customers"
    assert got[(4, 1, 5)] == "Potential Loyalists" and got[(3, 3, 1)] == "Promising"
    assert got[(2, 3, 3)] == "At Risk" and got[(1, 2, 1)] == "Lost Customers"
    assert got[(2, 1, 1)] == "Hibernating" and got[(3, 1, 1)] == "Need Attention"
    assert len(set(got.values())) == 8


def test_rfm_quantile_bins_are_qcut_not_ntile(spark):
    df = spark.createDataFrame([(k, 7) for k in range(1, 8)], "k long, n long")
    got = [r.b for r in df.select(notebook.qcut_score("k", "n").alias("b")).orderBy("k").collect()]
    assert [got.count(b) for b in range(1, 6)] == [2, 1, 1, 1, 2]


def test_discount_bands_both_variants(spark):
    pcts = ["0", "0.5", "1", "10", "10.5", "20", "30", "40", "41", "100"]
    df = spark.createDataFrame([(p,) for p in pcts], "p string").select(F.col("p").cast("decimal(5,2)").alias("p"))
    out = df.select("p", mp.kpi_discount_band(F.col("p")).alias("k"), mp.nb_discount_band(F.col("p")).alias("n"))
    got = {str(float(r.p)): (r.k, r.n) for r in out.collect()}
    assert got["0.0"] == ("0% (No Discount)", "No Discount")
    assert got["0.5"] == ("1–10%", "1-10%")
    assert got["10.0"] == ("1–10%", "11-20%")          # SQL upper-inclusive, notebook left-closed
    assert got["10.5"] == ("11–20%", "11-20%")          # no gap in the SQL variant
    assert got["40.0"] == ("31–40%", "40%+")
    assert got["41.0"] == ("40%+", "40%+")
    assert got["100.0"] == ("40%+", "40%+")


def test_clv_edges(spark):
    rows = [dict(customer_id=1, product_price="500.00"),                      # one-day customer
            dict(customer_id=2, product_price="1000.00"),
            dict(customer_id=3, product_price="5000.00"),
            dict(customer_id=4, product_price="10000.00"),
            dict(customer_id=5, product_price="100.00", discount_percent="100")]  # revenue 0
    wh = build_warehouse(spark, make_raw(spark, rows))
    sql = rows_by(customer.customer_clv(wh), "customer_id")
    assert sql[1]["annual_purchase_frequency"] is None
    assert sql[1]["clv_3yr_projection"] == 1500.0        # greatest(null, 1) -> 1 x 3 years
    assert [sql[i]["clv_tier"] for i in (2, 3, 4, 5)] == ["Silver", "Gold", "Platinum", "Bronze"]
    nb = rows_by(notebook.clv_clipped(wh), "customer_key")
    assert nb[1]["lifespan_days"] == 1 and nb[1]["clv_3yr_proj"] == 547500.0  # 365x larger
    assert [nb[i]["clv_tier"] for i in (2, 3, 4, 5)] == ["Bronze", "Silver", "Gold", None]


def test_pareto_exact_and_crossing(spark):
    wh = build_warehouse(spark, make_raw(spark, [dict(customer_id=i + 1, product_price=p)
                                                 for i, p in enumerate(["50", "30", "15", "5"])]))
    par = rows_by(customer.customer_pareto(wh), "customer_id")
    assert [par[i]["pareto_group"] for i in (1, 2, 3, 4)] == [mp.PARETO_TOP] * 2 + [mp.PARETO_BOTTOM] * 2
    assert notebook.pareto_point(wh).first().pct_customers_80 == 50.0
    wh2 = build_warehouse(spark, make_raw(spark, [dict(customer_id=i + 1, product_price=p)
                                                  for i, p in enumerate(["50", "31", "19"])]))
    par2 = rows_by(customer.customer_pareto(wh2), "customer_id")
    assert par2[2]["pareto_group"] == mp.PARETO_BOTTOM    # the crossing customer is bottom in SQL
    assert notebook.pareto_point(wh2).first().customers_to_80pct == 2   # and counted in the notebook


def test_country_is_latest_with_tie_break(spark):
    rows = [dict(customer_id=1, order_date=d(2024, 1, 1), customer_country="UK"),
            dict(customer_id=1, order_date=d(2024, 2, 1), customer_country="India"),
            dict(customer_id=2, order_date=d(2024, 3, 1), customer_country="UAE"),
            dict(customer_id=2, order_date=d(2024, 3, 1), customer_country="Canada")]
    wh = build_warehouse(spark, make_raw(spark, rows))
    c = rows_by(wh.dim_customer, "customer_id")
    assert c[1]["customer_country"] == "India"
    assert c[2]["customer_country"] == "Canada"         # same day: highest order_id wins


def test_product_in_two_categories_no_fanout(spark):
    rows = [dict(product_id=7, product_category="A"), dict(product_id=7, product_category="B"),
            dict(product_id=8, product_category="A")]
    wh = build_warehouse(spark, make_raw(spark, rows))
    assert wh.dim_product.count() == 3
    assert wh.fact.count() == 3
    dup = {(r.table_name, r.key_column): r.duplicates for r in q.unique_key_checks(wh).collect()}
    assert dup[("dim_product", "product_id")] == 1 and dup[("fact_sales", "order_id")] == 0


def test_duplicates_and_keep_first(spark):
    from tests.fixtures import raw_row
    rows = [raw_row(1, product_price="100.00"), raw_row(1, product_price="50.00"),
            raw_row(2, product_price="7.00"), raw_row(2, product_price="7.00")]
    seq = [2, 1, 3, 4]   # arrival order: the 50.00 line of order 1 came first
    df = spark.createDataFrame([r + (s,) for r, s in zip(rows, seq)],
                               make_raw(spark, [dict()]).schema.add(INGEST_SEQ, "long"))
    raw = df.select(*RAW_COLUMNS)
    assert q.dup_full_rows(raw).first().full_row_duplicates == 1
    assert q.dup_keys(raw).first().duplicate_keys == 2
    got = {r.order_id: str(r.product_price) for r in dedup_keep_first(df).collect()}
    assert got == {1: "50.00", 2: "7.00"}


def test_dirty_types_and_order_of_steps(spark):
    text = spark.createDataFrame(
        [("1", "2024-01-05", " USA ", "x", "4.0"), ("2", "2024-13-40", "UK", "3", None)],
        "order_id string, order_date string, customer_country string, quantity string, rating string")
    typed = q.trim_strings(q.coerce_types(text), ["customer_country"])
    rows = {r.order_id: r for r in typed.collect()}
    assert rows[1].customer_country == "USA" and rows[1].quantity is None     # 'x' -> null
    assert rows[2].order_date is None and rows[2].quantity == 3
    imputed = q.impute_median(typed.select("order_id", "quantity"))
    assert {r.order_id: r.quantity for r in imputed.collect()} == {1: 3.0, 2: 3.0}


def test_bad_formula_tolerances_are_strict(spark):
    rows = [dict(quantity=2, product_price="10.00", revenue="20.05"),
            dict(quantity=2, product_price="10.00", revenue="20.06"),
            dict(product_price="10.00", discounted_price="10.10"),
            dict(product_price="10.00", discounted_price="10.11")]
    raw = make_raw(spark, rows)
    assert q.check_revenue(raw).first().revenue_mismatches == 1
    assert q.check_discounted_price(raw).first().price_mismatches == 1


def test_constraints_counted_not_dropped(spark):
    rows = [dict(quantity=0), dict(discount_percent="101", discounted_price="0.00"), dict(is_returned=2),
            dict(revenue="-1.00"), dict()]
    raw = make_raw(spark, rows)
    got = {r.constraint_name: r.violations for r in q.constraint_checks(raw).collect()}
    assert got["chk_quantity_positive"] == 1 and got["chk_discount_range"] == 1
    assert got["chk_is_returned"] == 1 and got["chk_revenue_non_negative"] == 1
    assert q.quarantine(raw).count() == 4


def test_orphans_reported(spark):
    wh = build_warehouse(spark, make_raw(spark, [dict(), dict(customer_id=2)]))
    bad = wh.fact.withColumn("country_key", F.lit(99))
    wh2 = type(wh)(**{**wh.__dict__, "fact": bad})
    got = {r.foreign_key: (r.orphans, r.status) for r in q.referential_integrity(wh2).collect()}
    assert got["fact_sales.country_key"] == (2, "FAIL")
    assert got["fact_sales.customer_key"] == (0, "PASS")
    assert got["ALL"] == (2, "FAIL")


def test_zero_revenue_ratios_are_null(spark):
    wh = build_warehouse(spark, make_raw(spark, [dict(discount_percent="100")]))
    r = kpi.kpi_business_summary(wh).first()
    assert r.total_revenue == 0.0 and r.overall_profit_margin_pct is None
    assert wh.fact.first().profit_margin_pct is None


def test_rank_ties(spark):
    rows = [dict(customer_id=c, product_price=p) for c, p in [(1, "50"), (2, "50"), (3, "40")]]
    wh = build_warehouse(spark, make_raw(spark, rows))
    lb = rows_by(windows.win_customer_leaderboard(wh), "customer_id")
    assert [lb[c]["revenue_rank"] for c in (1, 2, 3)] == [1, 1, 3]
    assert [lb[c]["revenue_dense_rank"] for c in (1, 2, 3)] == [1, 1, 2]


def test_months_lag_by_row_and_lead_flat(spark):
    months = [d(2023, m, 1) for m in range(1, 13)] + [d(2024, 1, 1), d(2024, 2, 1)]
    wh = build_warehouse(spark, make_raw(spark, [dict(order_date=x, product_price=str(100 + i))
                                                 for i, x in enumerate(months)]))
    g = {(r.year, r.month): r for r in windows.win_mom_yoy_growth(wh).collect()}
    assert g[(2024, 1)].prev_year_same_month_revenue == 100.0
    lead = {(r.year, r.month): r for r in windows.win_lead_trend(wh).collect()}
    assert lead[(2024, 2)].next_month_revenue is None and lead[(2024, 2)].trend_signal == "Flat"
    assert lead[(2023, 1)].trend_signal == "Upward trend expected"
    rt = {(r.year, r.month): r for r in windows.win_running_totals(wh).collect()}
    assert rt[(2023, 12)].ytd_pct_of_annual == 100.0


def test_calendar_edges(spark):
    wh = build_warehouse(spark, make_raw(spark, [dict(order_date=d(2021, 1, 1)),
                                                 dict(order_date=d(2024, 4, 1))]))
    dd = rows_by(wh.dim_date, "full_date")
    sun = dd[d(2023, 12, 31)]
    assert sun["day_of_week"] == 1 and sun["is_weekend"] and sun["day_name"] == "Sunday"
    assert (dd[d(2024, 3, 31)]["fiscal_year"], dd[d(2024, 3, 31)]["fiscal_quarter"]) == (2023, 4)
    assert (dd[d(2024, 4, 1)]["fiscal_year"], dd[d(2024, 4, 1)]["fiscal_quarter"]) == (2024, 1)
    assert dd[d(2021, 1, 1)]["week_of_year"] == 53
    assert dd[d(2024, 4, 1)]["month_label"] == "Apr 2024" and dd[d(2024, 4, 1)]["quarter_label"] == "Q2 2024"
    assert wh.dim_date.count() == 366 + 365 * 3   # 2021-01-01 .. 2024-12-31


def test_cohort_sparse_vs_dense(spark):
    rows = [dict(customer_id=1, order_date=x) for x in (d(2024, 1, 5), d(2024, 2, 5), d(2024, 4, 5))]
    wh = build_warehouse(spark, make_raw(spark, rows))
    sparse = [(r.period_number, r.retention_rate_pct) for r in customer.cohort_retention(wh).collect()]
    assert sorted(sparse) == [(0, 100.0), (1, 100.0), (3, 100.0)]
    dense = notebook.cohort_matrix(wh).first()
    assert (dense.period_0, dense.period_1, dense.period_2, dense.period_3) == (100.0, 100.0, 0.0, 100.0)


def test_new_vs_returning_same_first_day(spark):
    rows = [dict(customer_id=1, order_date=d(2024, 1, 1)), dict(customer_id=1, order_date=d(2024, 1, 1)),
            dict(customer_id=1, order_date=d(2024, 2, 1))]
    wh = build_warehouse(spark, make_raw(spark, rows))
    got = {r.customer_type: r.orders for r in marketing.mkt_channel_new_vs_returning(wh).collect()}
    assert got == {"New Customer": 2, "Returning Customer": 1}


def test_leakage_classes_overlap(spark):
    wh = build_warehouse(spark, make_raw(spark, [dict(discount_percent="35", is_returned=1, rating="2.0")]))
    got = {r.leakage_type: r.affected_orders for r in executive.exec_profit_leakage(wh).collect()}
    assert set(got.values()) == {1} and len(got) == 3


GOLDEN_COUNTRY = [(1, "Australia", "Oceania", "AUD"), (2, "Canada", "North America", "CAD"),
                  (3, "Germany", "Europe", "EUR"), (4, "India", "South Asia", "INR"),
                  (5, "UAE", "Middle East", "AED"), (6, "UK", "Europe", "GBP"), (7, "USA", "North America", "USD")]
GOLDEN_SOURCE = [(1, "Direct", "Direct", False), (2, "Email", "Owned", False), (3, "Organic", "Organic", False),
                 (4, "Paid Ads", "Paid", True), (5, "Social Media", "Paid/Organic", True)]
GOLDEN_PAYMENT = [(1, "Apple Pay", "Digital Wallet", True), (2, "Cash on Delivery", "COD", False),
                  (3, "Credit Card", "Card", False), (4, "Debit Card", "Card", False),
                  (5, "PayPal", "Digital Wallet", True)]


def test_golden_dimensions(spark):
    rows = []
    for i in range(7):
        rows.append(dict(customer_country=GOLDEN_COUNTRY[i][1], traffic_source=GOLDEN_SOURCE[i % 5][1],
                         payment_method=GOLDEN_PAYMENT[(i * 2) % 5][1]))
    wh = build_warehouse(spark, make_raw(spark, rows))
    assert sorted(tuple(r) for r in wh.dim_country.collect()) == GOLDEN_COUNTRY
    assert sorted(tuple(r) for r in wh.dim_traffic_source.collect()) == GOLDEN_SOURCE
    assert sorted(tuple(r) for r in wh.dim_payment_method.collect()) == GOLDEN_PAYMENT
