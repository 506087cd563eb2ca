"""Order statistics by refinement, score limits, month states and cohort
masks against plain computations."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.fixtures import make_raw
from tillstar.operators import quality as q
from tillstar.operators import selection as sel
from tillstar.plans import customer, notebook, periods
from tillstar.plans.warehouse import build_warehouse


def plain(values, wanted):
    ordered = sorted(values)
    return {p: (ordered[p - 1], sum(v < ordered[p - 1] for v in values)) for p in wanted if 1 <= p <= len(values)}


@pytest.mark.parametrize("buckets", [2, 5, 1024])
def test_positions_of_whole_numbers(spark, buckets):
    rnd = random.Random(buckets)
    groups = {"one": [7], "same": [3] * 50, "few": [rnd.randrange(4) for _ in range(200)],
              "wide": [rnd.choice((-2 ** 63, 2 ** 63 - 1, 0, 1, 2 ** 62, 2 ** 62 + 1, -5)) for _ in range(90)],
              "hot": [5] * 300 + [rnd.randrange(10 ** 12) for _ in range(150)], "run": list(range(-40, 260))}
    rows = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("few", None), ("none", None)],
                                 "group string, value bigint").repartition(5)
    wanted = {g: [1, 2, len(vs) // 3, len(vs) // 2, len(vs) - 1, len(vs), len(vs) + 1, 0] for g, vs in groups.items()} | {"none": [1]}
    got = sel.select_positions(rows, wanted, "bigint", buckets)
    assert got == {g: plain(vs, wanted[g]) for g, vs in groups.items()} | {"none": {}}


def test_positions_of_doubles_and_long_decimals(spark):
    rnd = random.Random(1)
    values = [rnd.choice((math.inf, -math.inf, 1e308, -1e308, 0.0, 5e-324, 1.0, 1.0 + 2 ** -52)) for _ in range(80)]
    values += [rnd.gauss(0, 1) for _ in range(200)]
    rows = spark.createDataFrame([("d", v) for v in values] + [("d", math.nan), ("d", None)], "group string, value double")
    wanted = list(range(1, len(values) + 1, 7))
    assert sel.select_positions(rows, {"d": wanted}, "double") == {"d": plain(values, wanted)}
    big = [Decimal(rnd.randrange(10 ** 30)).scaleb(-6) for _ in range(100)]
    rows = spark.createDataFrame([("b", v) for v in big], "group string, value decimal(38,6)")
    assert sel.select_positions(rows, {"b": [1, 50, 99]}, "decimal(38,6)", 16) == {"b": plain(big, [1, 50, 99])}


def test_exact_quantiles_over_all_types(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.randrange(9), Decimal(rnd.randrange(10 ** 6)).scaleb(-2), rnd.random() if i % 5 else None,
             Decimal(rnd.randrange(10 ** 25)).scaleb(-3), None) for i in range(501)]
    df = spark.createDataFrame(rows, "a bigint, b int, c decimal(12,2), d double, e decimal(30,3), f int")
    probs = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]
    got = {(r["column_name"], r["p"]): r["value"] for r in q.exact_quantiles(df, list("abcdef"), probs).collect()}
    for k, c in enumerate("abcde"):
        values = sorted(r[k] for r in rows if r[k] is not None)
        for p in probs:
            h = (len(values) - 1) * p
            lo, hi = float(values[math.floor(h)]), float(values[min(math.floor(h) + 1, len(values) - 1)])
            assert got[c, p] == lo + (hi - lo) * (h - math.floor(h))
    assert len(got) == 5 * len(probs)
    assert q.exact_quantiles(df.limit(0), ["a", "d"], probs).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 6, 11, 237])
def test_scores_match_ntile_and_qcut(spark, n):
    rnd = random.Random(n)
    df = spark.createDataFrame([(i * 7 % 1009, rnd.randrange(5), rnd.randrange(1000)) for i in range(n)], "id bigint, x int, y int")
    df = df.repartition(4)
    limits = sel.order_limits(df, {"x": "-x", "y": "y"}, "id", sel.ntile_cuts(5))
    other = sel.order_limits(df, {"x": "x"}, "id", notebook.qcut_cuts())
    by = {"nx": Window.orderBy(F.desc("x"), "id"), "ny": Window.orderBy("y", "id"), "rk": Window.orderBy("x", "id")}
    got = df.select(sel.part_of("-x", "id", limits["x"]).alias("gx"), F.ntile(5).over(by["nx"]).alias("wx"),
                    sel.part_of("y", "id", limits["y"]).alias("gy"), F.ntile(5).over(by["ny"]).alias("wy"),
                    sel.part_of("x", "id", other["x"]).alias("gq"), F.row_number().over(by["rk"]).alias("rk"), F.lit(n).alias("n"))
    got = got.withColumn("wq", notebook.qcut_score("rk", "n")).collect()
    assert len(got) == n
    assert all(r["gx"] == r["wx"] and r["gy"] == r["wy"] and r["gq"] == r["wq"] for r in got)


@pytest.fixture(scope="module")
def long_star(spark):
    """Orders over eleven years, so that cohort masks need three words."""
    rnd = random.Random(4)
    rows = [dict(customer_id=1 + rnd.randrange(40), product_id=1 + i % 5, product_category="A",
                 order_date=dt.date(2014, 3, 1) + dt.timedelta(days=rnd.randrange(4000)), product_price="10.00",
                 discount_percent="0", quantity=1, rating=None, is_returned=0) for i in range(400)]
    wh = build_warehouse(spark, make_raw(spark, rows))
    yield wh
    wh.release()


def test_cohorts_over_many_years(long_star):
    got = {(r["cohort_month"], r["order_month"]): (r["customers"], r["period_number"])
           for r in customer.cohort_counts(long_star).collect()}
    orders = [(r["customer_id"], r["order_date"].replace(day=1)) for r in long_star.clean.collect()]
    first = {}
    for c, m in orders:
        first[c] = min(m, first.get(c, m))
    cells = {}
    for c, m in orders:
        cells.setdefault((first[c], m), set()).add(c)
    assert got == {(a, b): (len(v), (b.year - a.year) * 12 + b.month - a.month) for (a, b), v in cells.items()}


def test_scores_need_no_order_of_customers(long_star):
    for df in (customer.rfm_base(long_star), notebook._build_rfm_quantile_df(long_star)):
        text = df._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]
        assert text and "Window" not in text and "Sort" not in text


def test_month_states_count_customers_of_many_blocks(spark, long_star):
    wide = long_star.fact.withColumn("customer_key", F.col("customer_key") * 30_000 + F.col("order_id") % 3)
    states = periods.month_states(wide)
    assert states.select("customer_block").distinct().count() > 20
    united = states.groupBy("customer_block").agg(F.expr("bitmap_or_agg(customers)").alias("b"))
    assert united.agg(F.sum(F.expr("bitmap_count(b)"))).first()[0] == wide.select("customer_key").distinct().count()
    got = {r["year"]: (r["customers"], r["orders"], r["revenue"]) for r in periods.roll_up(long_star, "year").collect()}
    want = long_star.with_dims(long_star.fact, date=["year"]).groupBy("year").agg(
        F.countDistinct("customer_key").alias("c"), F.count("*").alias("o"), F.sum("revenue").alias("r")).collect()
    assert got == {r["year"]: (r["c"], r["o"], r["r"]) for r in want}


def test_empty_star(spark):
    wh = build_warehouse(spark, make_raw(spark, []))
    assert customer.cohort_counts(wh).collect() == [] == customer.rfm_base(wh).collect()
    assert periods.roll_up(wh).first()["customers"] == 0 and periods.roll_up(wh, "year").collect() == []
    wh.release()


def test_outliers_keep_rows_wide(spark):
    rows = [(float(i), None if i % 10 else i, None) for i in range(100)] + [(1000.0, None, None), (None, -500, None)]
    df = spark.createDataFrame(rows, "a double, b int, c double")
    found = q.outliers_iqr(df, ["a", "b", "c"])
    # what is stacked is the counts, not the rows
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = [plan[i + 1] for i, line in enumerate(plan) if "Generate" in line]
    assert below and all("Aggregate" in line for line in below)
    got = {r.column_name: r for r in found.collect()}
    assert set(got) == {"a", "b"}                          # a column without values has no bounds
    assert (got["a"].outlier_count, got["a"].q1, got["a"].q3) == (1, 25.0, 75.0)
    assert (got["b"].outlier_count, got["b"].q1, got["b"].q3) == (1, 15.0, 65.0)
    assert got["a"].outlier_pct == got["b"].outlier_pct
    assert q.outliers_iqr(df.limit(0), ["a", "b"]).count() == 0
