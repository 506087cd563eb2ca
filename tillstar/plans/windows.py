"""Window-function reports.

Month / quarter series are bounded by the calendar (12 rows a year), so
their windows run without PARTITION BY.  Product and customer rankings grow
with the data and go through :func:`ordered_stats` (range-partitioned above
a size threshold) or a top-k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions import mappings as mp
from tillstar.functions.metrics import big, dbl, margin_pct, money, orders_count, pct, ratio, snap_round
from tillstar.operators.ranking import OrderSpec, ordered_stats
from tillstar.plans.warehouse import Warehouse

UNB, CUR = Window.unboundedPreceding, Window.currentRow


def _build_monthly_series(wh: Warehouse) -> DataFrame:
    """(year, month, month_label) -> exact revenue / profit sums, orders."""
    f = wh.with_dims(wh.fact, date=["year", "month", "month_label"])
    return f.groupBy("year", "month", "month_label").agg(
        F.round(F.sum("revenue"), 2).alias("revenue"),
        F.round(F.sum("profit"), 2).alias("profit"),
        big(orders_count()).alias("orders"))


def monthly_series(wh: Warehouse) -> DataFrame:
    return wh.memo("monthly_series", lambda: _build_monthly_series(wh))


def _build_product_totals(wh: Warehouse) -> DataFrame:
    """Per product: fact aggregated by surrogate key first, then joined to the
    product dimension (a product-grain join instead of a fact-grain join)."""
    agg = wh.fact.groupBy("product_key").agg(
        F.sum("revenue").alias("rev"), F.sum("profit").alias("prof"),
        orders_count().alias("orders"), F.sum("quantity").alias("units"),
        F.sum("discount_percent").alias("disc_sum"), F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_n"), F.sum("is_returned").alias("returned"))
    return agg.join(wh.dim("product", "product_id", "product_category"), "product_key")


def product_totals(wh: Warehouse) -> DataFrame:
    return wh.memo("product_totals", lambda: _build_product_totals(wh))


def _build_customer_totals(wh: Warehouse) -> DataFrame:
    agg = wh.fact.groupBy("customer_key").agg(
        F.sum("revenue").alias("rev"), F.sum("profit").alias("prof"), orders_count().alias("orders"),
        F.min("date_key").alias("first_key"), F.max("date_key").alias("last_key"))
    return agg.join(wh.dim("customer", "customer_id", "customer_country"), "customer_key")


def customer_totals(wh: Warehouse) -> DataFrame:
    return wh.memo("customer_totals", lambda: _build_customer_totals(wh))


def win_product_row_number(wh: Warehouse) -> DataFrame:
    p = product_totals(wh)
    ranked = ordered_stats(p, OrderSpec(keys=[("rev", True)], tie_break=[("product_key", False)]),
                           partition_by=["product_category"], row_number="row_num_in_category",
                           expected_rows=wh.product_rows())
    return ranked.select("product_category", big("product_key").alias("product_key"),
                         big("product_id").alias("product_id"), money("rev").alias("category_revenue"),
                         money("prof").alias("category_profit"), "row_num_in_category")


def win_top_product_per_category(wh: Warehouse) -> DataFrame:
    """Rank-1 rows of the category ranking.  ``row_number() = 1`` plans as a
    WindowGroupLimit, so each task keeps one row per category before the
    shuffle."""
    p = product_totals(wh)
    w = Window.partitionBy("product_category").orderBy(F.desc("rev"), F.asc("product_key"))
    top = p.withColumn("row_num_in_category", F.row_number().over(w)).filter("row_num_in_category = 1")
    return top.select("product_category", big("product_key").alias("product_key"),
                      big("product_id").alias("product_id"), money("rev").alias("category_revenue"),
                      money("prof").alias("category_profit"), big("row_num_in_category").alias("row_num_in_category"))


def win_customer_leaderboard(wh: Warehouse, limit: int = 50) -> DataFrame:
    """Top customers by revenue with RANK, DENSE_RANK and RANK within country.

    Every customer ranked above a top-k customer is itself in the top k, so
    all three ranks are exact when computed on the top-k rows alone."""
    c = customer_totals(wh)
    top = c.orderBy(F.desc("rev"), F.asc("customer_id")).limit(limit)
    w = Window.orderBy(F.desc("rev"))
    return (top.select(
        big("customer_id").alias("customer_id"), "customer_country",
        money("rev").alias("total_revenue"), money("prof").alias("total_profit"),
        big("orders").alias("orders"),
        big(F.rank().over(w)).alias("revenue_rank"),
        big(F.dense_rank().over(w)).alias("revenue_dense_rank"),
        big(F.rank().over(Window.partitionBy("customer_country").orderBy(F.desc("rev")))).alias("country_revenue_rank"),
        F.col("rev"))
        .orderBy("revenue_rank", "customer_id").drop("rev"))


def win_mom_yoy_growth(wh: Warehouse) -> DataFrame:
    m = monthly_series(wh)
    w = Window.orderBy("year", "month")
    lag1, lag12 = F.lag("revenue", 1).over(w), F.lag("revenue", 12).over(w)
    return (m.select(
        big("year").alias("year"), big("month").alias("month"), "month_label",
        dbl("revenue").alias("revenue"), dbl("profit").alias("profit"), "orders",
        dbl(lag1).alias("prev_month_revenue"),
        money(F.col("revenue") - lag1).alias("mom_revenue_change"),
        pct(F.col("revenue") - lag1, lag1).alias("mom_revenue_growth_pct"),
        dbl(lag12).alias("prev_year_same_month_revenue"),
        pct(F.col("revenue") - lag12, lag12).alias("yoy_revenue_growth_pct"))
        .orderBy("year", "month"))


def win_lead_trend(wh: Warehouse) -> DataFrame:
    m = monthly_series(wh)
    nxt = F.lead("revenue", 1).over(Window.orderBy("year", "month"))
    return (m.select(
        big("year").alias("year"), big("month").alias("month"), "month_label",
        dbl("revenue").alias("current_revenue"),
        dbl(nxt).alias("next_month_revenue"),
        money(F.col("revenue") - nxt).alias("revenue_gap_to_next"),
        F.when(nxt > F.col("revenue"), mp.TREND_UP).when(nxt < F.col("revenue"), mp.TREND_DOWN)
         .otherwise(mp.TREND_FLAT).alias("trend_signal"))
        .orderBy("year", "month"))


def win_running_totals(wh: Warehouse) -> DataFrame:
    m = monthly_series(wh)
    wy = Window.partitionBy("year").orderBy("month")
    return (m.select(
        big("year").alias("year"), big("month").alias("month"), "month_label",
        dbl("revenue").alias("monthly_revenue"), dbl("profit").alias("monthly_profit"),
        dbl(F.sum("revenue").over(wy.rowsBetween(UNB, CUR))).alias("ytd_revenue"),
        dbl(F.sum("profit").over(wy.rowsBetween(UNB, CUR))).alias("ytd_profit"),
        dbl(F.sum("revenue").over(Window.orderBy("year", "month").rowsBetween(UNB, CUR)))
         .alias("all_time_cumulative_revenue"),
        pct(F.sum("revenue").over(wy), F.sum("revenue").over(Window.partitionBy("year")))
         .alias("ytd_pct_of_annual"))
        .orderBy("year", "month"))


def win_moving_average(wh: Warehouse) -> DataFrame:
    m = monthly_series(wh)
    w3 = Window.orderBy("year", "month").rowsBetween(-2, CUR)
    wa = Window.partitionBy()
    above = F.col("revenue") * F.count(F.lit(1)).over(wa) > F.sum("revenue").over(wa)
    return (m.select(
        big("year").alias("year"), big("month").alias("month"), "month_label",
        dbl("revenue").alias("monthly_revenue"), dbl("profit").alias("monthly_profit"),
        ratio(F.sum("revenue").over(w3), F.count("revenue").over(w3)).alias("rolling_3m_avg_revenue"),
        ratio(F.sum("profit").over(w3), F.count("profit").over(w3)).alias("rolling_3m_avg_profit"),
        ratio(F.sum("revenue").over(wa), F.count("revenue").over(wa)).alias("overall_avg_monthly_revenue"),
        F.when(above, mp.ABOVE_AVG).otherwise(mp.BELOW_AVG).alias("vs_avg_signal"))
        .orderBy("year", "month"))


def win_product_quartiles(wh: Warehouse) -> DataFrame:
    p = product_totals(wh).select(
        "product_id", "product_category", F.round("rev", 2).alias("total_revenue"),
        F.round("prof", 2).alias("total_profit"), margin_pct(F.col("prof"), F.col("rev")).alias("margin_pct"),
        big("orders").alias("orders"))
    n = wh.product_rows()
    tie = [("product_id", False), ("product_category", False)]
    by_rev = ordered_stats(p, OrderSpec(keys=[("total_revenue", True)], tie_break=tie),
                           percent_rank="_pr", ntiles={"revenue_quartile": 4}, expected_rows=n)
    by_margin = ordered_stats(by_rev, OrderSpec(keys=[("margin_pct", True)], tie_break=tie),
                              ntiles={"margin_quartile": 4}, expected_rows=n)
    tiers = mp.PERFORMANCE_TIERS
    tier = (F.when(F.col("revenue_quartile") == 1, tiers[0]).when(F.col("revenue_quartile") == 2, tiers[1])
            .when(F.col("revenue_quartile") == 3, tiers[2]).when(F.col("revenue_quartile") == 4, tiers[3]))
    return by_margin.select(
        big("product_id").alias("product_id"), "product_category", dbl("total_revenue").alias("total_revenue"),
        dbl("total_profit").alias("total_profit"), "margin_pct", "orders",
        snap_round(F.col("_pr"), 4).alias("revenue_percent_rank"),
        "revenue_quartile", "margin_quartile", tier.alias("performance_tier"))


def win_year_baseline(wh: Warehouse) -> DataFrame:
    m = monthly_series(wh)
    wy = Window.partitionBy("year").orderBy("month").rowsBetween(UNB, Window.unboundedFollowing)
    first = F.first("revenue").over(wy)
    return (m.select(
        big("year").alias("year"), big("month").alias("month"), "month_label",
        dbl("revenue").alias("revenue"),
        dbl(first).alias("year_start_revenue"),
        dbl(F.last("revenue").over(wy)).alias("year_end_revenue"),
        pct(F.col("revenue") - first, first).alias("growth_vs_year_start_pct"))
        .orderBy("year", "month"))


VIEWS = {
    "win_product_row_number": win_product_row_number,
    "win_top_product_per_category": win_top_product_per_category,
    "win_customer_leaderboard": win_customer_leaderboard,
    "win_mom_yoy_growth": win_mom_yoy_growth,
    "win_lead_trend": win_lead_trend,
    "win_running_totals": win_running_totals,
    "win_moving_average": win_moving_average,
    "win_product_quartiles": win_product_quartiles,
    "win_year_baseline": win_year_baseline,
}
