"""Executive reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions import calendar as cal
from tillstar.functions import mappings as mp
from tillstar.functions.metrics import (avg_of, big, dbl, discount_rate_pct, margin_pct, money, orders_count,
                                        pct, ratio, return_rate_pct)
from tillstar.plans import periods
from tillstar.plans.warehouse import Warehouse
from tillstar.plans.windows import customer_totals, product_totals

UNB, CUR = Window.unboundedPreceding, Window.currentRow


def _total_revenue(wh: Warehouse) -> DataFrame:
    """One-row grand total, cross-joined back (bounded: exactly one row)."""
    return wh.fact.agg(F.sum("revenue").alias("_tot"))


def exec_scorecard(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, date=["full_date"])
    return f.agg(
        big(orders_count()).alias("total_orders"),
        big(F.countDistinct("customer_key")).alias("total_customers"),
        big(F.sum("quantity")).alias("total_units_sold"),
        money(F.sum("revenue")).alias("net_revenue"),
        money(F.sum("gross_revenue")).alias("gross_revenue"),
        money(F.sum("discount_amount")).alias("total_discounts"),
        money(F.sum("shipping_cost")).alias("total_shipping"),
        money(F.sum("profit")).alias("net_profit"),
        margin_pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"),
        ratio(F.sum("revenue"), orders_count()).alias("avg_order_value"),
        ratio(F.sum("revenue"), F.countDistinct("customer_key")).alias("avg_revenue_per_customer"),
        discount_rate_pct().alias("discount_rate_pct"),
        return_rate_pct().alias("return_rate_pct"),
        avg_of("rating").alias("avg_product_rating"),
        F.min("full_date").alias("period_start"),
        F.max("full_date").alias("period_end"))


def exec_monthly_trend(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, date=["year", "month", "month_label", "quarter_label"])
    m = f.groupBy("year", "month", "month_label", "quarter_label").agg(
        big(orders_count()).alias("orders"),
        big(F.countDistinct("customer_key")).alias("customers"),
        F.sum("revenue").alias("_rev"),
        money(F.sum("profit")).alias("profit"),
        money(F.sum("discount_amount")).alias("discounts"),
        ratio(F.sum("revenue"), orders_count()).alias("aov"),
        margin_pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"))
    prev = F.lag("_rev").over(Window.orderBy("year", "month"))
    ytd = F.sum("_rev").over(Window.partitionBy("year").orderBy("month").rowsBetween(UNB, CUR))
    return (m.select(big("year").alias("year"), big("month").alias("month"), "month_label", "quarter_label",
                     "orders", "customers", money("_rev").alias("revenue"), "profit", "discounts", "aov",
                     "profit_margin_pct", pct(F.col("_rev") - prev, prev).alias("mom_revenue_growth_pct"),
                     dbl(ytd).alias("ytd_revenue"))
             .orderBy("year", "month"))


def exec_top_products(wh: Warehouse, limit: int = 10) -> DataFrame:
    """Top products by revenue.  RANK over all products equals RANK inside
    the top-k; the share uses the one-row grand total."""
    p = product_totals(wh)
    top = p.orderBy(F.desc("rev"), "product_id", "product_category").limit(limit).crossJoin(F.broadcast(_total_revenue(wh)))
    return (top.select(
        big(F.rank().over(Window.orderBy(F.desc("rev")))).alias("rank"),
        big("product_id").alias("product_id"), "product_category",
        big("orders").alias("orders"), big("units").alias("units_sold"),
        money("rev").alias("revenue"), money("prof").alias("profit"),
        margin_pct(F.col("prof"), F.col("rev")).alias("profit_margin_pct"),
        ratio("disc_sum", "orders").alias("avg_discount_pct"),
        ratio("rating_sum", "rating_n").alias("avg_rating"),
        pct("returned", "orders").alias("return_rate_pct"),
        pct("rev", "_tot").alias("revenue_share_pct"))
        .orderBy(F.desc("revenue"), "product_id", "product_category"))


def exec_category_scorecard(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, product=["product_category"])
    g = f.groupBy("product_category").agg(
        big(orders_count()).alias("orders"),
        big(F.sum("quantity")).alias("units_sold"),
        big(F.countDistinct("customer_key")).alias("unique_customers"),
        F.sum("revenue").alias("_rev"),
        money(F.sum("gross_revenue")).alias("gross_revenue"),
        money(F.sum("profit")).alias("profit"),
        money(F.sum("discount_amount")).alias("total_discounts"),
        ratio(F.sum("revenue"), orders_count()).alias("aov"),
        margin_pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"),
        avg_of("discount_percent").alias("avg_discount_pct"),
        avg_of("rating").alias("avg_rating"),
        return_rate_pct().alias("return_rate_pct"))
    tot = F.sum("_rev").over(Window.partitionBy())
    return (g.select("product_category", "orders", "units_sold", "unique_customers", money("_rev").alias("revenue"),
                     "gross_revenue", "profit", "total_discounts", "aov", "profit_margin_pct", "avg_discount_pct",
                     "avg_rating", "return_rate_pct", pct(F.col("_rev"), tot).alias("revenue_share_pct"),
                     big(F.dense_rank().over(Window.orderBy(F.desc("_rev")))).alias("revenue_rank"))
             .orderBy(F.desc("revenue"), "product_category"))


def exec_top_customers(wh: Warehouse, limit: int = 10) -> DataFrame:
    c = customer_totals(wh)
    top = c.orderBy(F.desc("rev"), "customer_id").limit(limit).crossJoin(F.broadcast(_total_revenue(wh)))
    w = Window.orderBy(F.desc("rev"), F.asc("customer_id"))
    return (top.select(
        big(F.rank().over(Window.orderBy(F.desc("rev")))).alias("rank"),
        big("customer_id").alias("customer_id"), "customer_country",
        big("orders").alias("orders"),
        money("rev").alias("lifetime_revenue"), money("prof").alias("lifetime_profit"),
        ratio("rev", "orders").alias("aov"),
        margin_pct(F.col("prof"), F.col("rev")).alias("profit_margin_pct"),
        cal.key_to_date(F.col("first_key")).alias("first_order_date"),
        cal.key_to_date(F.col("last_key")).alias("last_order_date"),
        pct("rev", "_tot").alias("revenue_share_pct"),
        pct(F.sum("rev").over(w.rowsBetween(UNB, CUR)), F.col("_tot")).alias("cumulative_revenue_pct"))
        .orderBy(F.desc("lifetime_revenue"), "customer_id"))


def _ranked_share(g: DataFrame) -> DataFrame:
    tot = F.sum("_rev").over(Window.partitionBy())
    return (g.withColumn("rank", big(F.rank().over(Window.orderBy(F.desc("_rev")))))
             .withColumn("revenue", money("_rev"))
             .withColumn("revenue_share_pct", pct(F.col("_rev"), tot)))


def exec_top_countries(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, country=["country_name", "region"])
    g = f.groupBy("country_name", "region").agg(
        big(orders_count()).alias("orders"),
        big(F.countDistinct("customer_key")).alias("customers"),
        F.sum("revenue").alias("_rev"),
        money(F.sum("profit")).alias("profit"),
        ratio(F.sum("revenue"), orders_count()).alias("aov"),
        margin_pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"),
        return_rate_pct().alias("return_rate_pct"))
    return (_ranked_share(g).select("rank", "country_name", "region", "orders", "customers", "revenue", "profit",
                                    "aov", "profit_margin_pct", "return_rate_pct", "revenue_share_pct")
            .orderBy(F.desc("revenue"), "country_name"))


def exec_top_channels(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, traffic_source=["traffic_source", "channel_type", "is_paid"])
    g = f.groupBy("traffic_source", "channel_type", "is_paid").agg(
        big(orders_count()).alias("orders"),
        big(F.countDistinct("customer_key")).alias("customers"),
        F.sum("revenue").alias("_rev"),
        money(F.sum("profit")).alias("profit"),
        money(F.sum("discount_amount")).alias("discounts"),
        ratio(F.sum("revenue"), orders_count()).alias("aov"),
        margin_pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"),
        return_rate_pct().alias("return_rate_pct"))
    return (_ranked_share(g).select("rank", "traffic_source", "channel_type", "is_paid", "orders", "customers",
                                    "revenue", "profit", "discounts", "aov", "profit_margin_pct",
                                    "return_rate_pct", "revenue_share_pct")
            .orderBy(F.desc("revenue"), "traffic_source"))


def exec_qbr(wh: Warehouse) -> DataFrame:
    g = periods.roll_up(wh, "year", "quarter", "quarter_label")
    prev = F.lag("revenue").over(Window.orderBy("year", "quarter"))      # a row a quarter
    return (g.select(big("year").alias("year"), big("quarter").alias("quarter"), "quarter_label",
                     money("gross_revenue").alias("gross_revenue"), money("discount_amount").alias("less_discounts"),
                     money("revenue").alias("net_revenue"), money("shipping_cost").alias("shipping_costs"),
                     money("profit").alias("operating_profit"),
                     margin_pct(F.col("profit"), F.col("revenue")).alias("profit_margin_pct"),
                     periods.orders().alias("orders"), big("customers").alias("active_customers"),
                     ratio("rating", "ratings").alias("avg_rating"), pct("is_returned", "orders").alias("return_rate_pct"),
                     pct(F.col("revenue") - prev, prev).alias("qoq_revenue_growth_pct"))
             .orderBy("year", "quarter"))


def exec_returns(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, product=["product_category"])
    ret, kept = F.col("is_returned") == 1, F.col("is_returned") == 0
    return (f.groupBy("product_category").agg(
        big(orders_count()).alias("total_orders"),
        big(F.sum("is_returned")).alias("returned_orders"),
        return_rate_pct().alias("return_rate_pct"),
        money(F.sum(F.when(ret, F.col("revenue")).otherwise(F.lit(0)))).alias("returned_revenue"),
        money(F.sum(F.when(ret, F.col("profit")).otherwise(F.lit(0)))).alias("returned_profit_lost"),
        avg_of(F.when(ret, F.col("rating"))).alias("avg_rating_returned"),
        avg_of(F.when(kept, F.col("rating"))).alias("avg_rating_kept"),
        avg_of(F.when(ret, F.col("discount_percent"))).alias("avg_discount_on_returns"))
        .orderBy(F.desc("return_rate_pct"), "product_category"))


def exec_profit_leakage(wh: Warehouse) -> DataFrame:
    """Three overlapping leakage classes from ONE scan: conditional sums in a
    single global aggregate, then unpivoted to three rows with ``stack``."""
    f = wh.fact
    hd = F.col("discount_percent") > 30
    rt = F.col("is_returned") == 1
    lr = F.col("rating") <= 2.0

    def s(cond, col):
        return F.sum(F.when(cond, F.col(col)))

    a = f.agg(
        F.count(F.when(hd, 1)).alias("hd_n"), s(hd, "discount_amount").alias("hd_disc"),
        s(hd, "profit").alias("hd_prof"), s(hd, "revenue").alias("hd_rev"),
        F.sum("is_returned").alias("rt_n"),
        F.sum(F.when(rt, F.col("profit")).otherwise(F.lit(0))).alias("rt_prof"),
        F.sum(F.when(rt, F.col("revenue")).otherwise(F.lit(0))).alias("rt_rev"),
        F.count(F.when(lr, 1)).alias("lr_n"), s(lr, "discount_amount").alias("lr_disc"),
        s(lr, "profit").alias("lr_prof"), s(lr, "revenue").alias("lr_rev"))
    rows = a.select(
        big("hd_n").alias("n1"), money("hd_disc").alias("d1"), money("hd_prof").alias("p1"),
        margin_pct(F.col("hd_prof"), F.col("hd_rev")).alias("m1"),
        big("rt_n").alias("n2"), F.lit(0.0).alias("d2"), money("rt_prof").alias("p2"),
        margin_pct(F.col("rt_prof"), F.col("rt_rev")).alias("m2"),
        big("lr_n").alias("n3"), money("lr_disc").alias("d3"), money("lr_prof").alias("p3"),
        margin_pct(F.col("lr_prof"), F.col("lr_rev")).alias("m3"))
    stacked = rows.selectExpr(
        f"stack(3, '{mp.LEAK_DISCOUNT}', n1, d1, p1, m1, '{mp.LEAK_RETURNS}', n2, d2, p2, m2, "
        f"'{mp.LEAK_LOW_RATING}', n3, d3, p3, m3) AS (leakage_type, affected_orders, discount_cost, "
        f"profit_generated, margin_pct)")
    return stacked.orderBy(F.asc_nulls_first("profit_generated"))


VIEWS = {
    "exec_scorecard": exec_scorecard,
    "exec_monthly_trend": exec_monthly_trend,
    "exec_top_products": exec_top_products,
    "exec_category_scorecard": exec_category_scorecard,
    "exec_top_customers": exec_top_customers,
    "exec_top_countries": exec_top_countries,
    "exec_top_channels": exec_top_channels,
    "exec_qbr": exec_qbr,
    "exec_returns": exec_returns,
    "exec_profit_leakage": exec_profit_leakage,
}
