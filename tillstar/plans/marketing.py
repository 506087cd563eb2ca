"""Marketing-channel views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions import calendar as cal
from tillstar.functions import mappings as mp
from tillstar.functions.metrics import (avg_of, big, margin_pct, money, orders_count, pct, ratio,
                                        return_rate_pct)
from tillstar.plans.warehouse import Warehouse


def _grand_total(df: DataFrame, col: str, out: str) -> DataFrame:
    """Attach SUM(col) over all rows of a small grouped result."""
    return df.withColumn(out, F.sum(col).over(Window.partitionBy()))


def mkt_channel_performance(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, traffic_source=["traffic_source", "channel_type", "is_paid"])
    g = f.groupBy("traffic_source", "channel_type", "is_paid").agg(
        big(orders_count()).alias("total_orders"),
        big(F.countDistinct("customer_key")).alias("unique_customers"),
        big(F.sum("quantity")).alias("units_sold"),
        F.sum("revenue").alias("_rev"),
        money(F.sum("gross_revenue")).alias("gross_revenue"),
        money(F.sum("profit")).alias("total_profit"),
        money(F.sum("discount_amount")).alias("total_discounts"),
        ratio(F.sum("revenue"), orders_count()).alias("aov"),
        margin_pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"),
        return_rate_pct().alias("return_rate_pct"),
        avg_of("rating").alias("avg_rating"))
    g = _grand_total(g, "_rev", "_tot")
    return (g.select("traffic_source", "channel_type", "is_paid", "total_orders", "unique_customers",
                     "units_sold", money("_rev").alias("total_revenue"), "gross_revenue", "total_profit",
                     "total_discounts", "aov", "profit_margin_pct", "return_rate_pct", "avg_rating",
                     pct("_rev", "_tot").alias("revenue_share_pct"))
             .orderBy(F.desc("total_revenue"), "traffic_source"))


def mkt_channel_monthly_trend(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, date=["year", "month", "month_label"],
                     traffic_source=["traffic_source", "channel_type"])
    return (f.groupBy("year", "month", "month_label", "traffic_source", "channel_type").agg(
        big(orders_count()).alias("orders"),
        money(F.sum("revenue")).alias("revenue"),
        money(F.sum("profit")).alias("profit"),
        ratio(F.sum("revenue"), orders_count()).alias("aov"),
        margin_pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"))
        .select(big("year").alias("year"), big("month").alias("month"), "month_label", "traffic_source",
                "channel_type", "orders", "revenue", "profit", "aov", "profit_margin_pct")
        .orderBy("year", "month", F.desc("revenue"), "traffic_source"))


def mkt_channel_category_matrix(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, traffic_source=["traffic_source"], product=["product_category"])
    return (f.groupBy("traffic_source", "product_category").agg(
        big(orders_count()).alias("orders"),
        money(F.sum("revenue")).alias("revenue"),
        money(F.sum("profit")).alias("profit"),
        margin_pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"),
        avg_of("discount_percent").alias("avg_discount_pct"))
        .orderBy(F.desc("revenue"), "traffic_source", "product_category"))


def mkt_channel_country_matrix(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, traffic_source=["traffic_source"], country=["country_name", "region"])
    return (f.groupBy("traffic_source", "country_name", "region").agg(
        big(orders_count()).alias("orders"),
        money(F.sum("revenue")).alias("revenue"),
        money(F.sum("profit")).alias("profit"),
        ratio(F.sum("revenue"), orders_count()).alias("aov"))
        .orderBy(F.desc("revenue"), "traffic_source", "country_name"))


def mkt_channel_new_vs_returning(wh: Warehouse) -> DataFrame:
    """An order is "new" when it falls on the customer's first order date
    (all orders of that first day count as new).  The first date comes from
    the customer dimension (a per-customer join, not a window over orders)."""
    o = wh.with_dims(wh.fact.select("date_key", "customer_key", "traffic_source_key", "revenue", "profit"),
                     customer=["customer_id", "first_order_date"], traffic_source=["traffic_source"])
    o = o.withColumn("order_date", cal.key_to_date(F.col("date_key")))
    o = o.withColumn("customer_type", F.when(F.col("order_date") == F.col("first_order_date"), mp.NEW_CUSTOMER)
                     .otherwise(mp.RETURNING_CUSTOMER))
    g = o.groupBy("traffic_source", "customer_type").agg(
        big(orders_count()).alias("orders"),
        big(F.countDistinct("customer_id")).alias("customers"),
        F.sum("revenue").alias("_rev"),
        money(F.sum("profit")).alias("profit"),
        ratio(F.sum("revenue"), orders_count()).alias("aov"))
    g = g.withColumn("_chan", F.sum("_rev").over(Window.partitionBy("traffic_source")))
    return (g.select("traffic_source", "customer_type", "orders", "customers", money("_rev").alias("revenue"),
                     "profit", "aov", pct("_rev", "_chan").alias("pct_channel_revenue"))
             .orderBy("traffic_source", "customer_type"))


def mkt_channel_efficiency_ranking(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, traffic_source=["traffic_source", "is_paid"])
    base = f.groupBy("traffic_source", "is_paid").agg(
        money(F.sum("revenue")).alias("revenue"),
        money(F.sum("profit")).alias("profit"),
        margin_pct(F.sum("profit"), F.sum("revenue")).alias("margin_pct"),
        ratio(F.sum("revenue"), orders_count()).alias("aov"),
        return_rate_pct().alias("return_rate_pct"),
        avg_of("discount_percent").alias("avg_discount_pct"))
    # one row per channel: global windows over a handful of rows
    return (base
            .withColumn("margin_rank", big(F.rank().over(Window.orderBy(F.desc_nulls_last("margin_pct")))))
            .withColumn("aov_rank", big(F.rank().over(Window.orderBy(F.desc_nulls_last("aov")))))
            .withColumn("return_rank", big(F.rank().over(Window.orderBy(F.asc_nulls_last("return_rate_pct")))))
            .withColumn("profit_rank", big(F.rank().over(Window.orderBy(F.desc_nulls_last("profit")))))
            .orderBy(F.desc("profit"), "traffic_source"))


def mkt_channel_discount_analysis(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, traffic_source=["traffic_source", "is_paid"])
    disc = F.col("discount_percent") > 0
    return (f.groupBy("traffic_source", "is_paid").agg(
        big(orders_count()).alias("total_orders"),
        big(F.sum(F.when(disc, 1).otherwise(0))).alias("discounted_orders"),
        pct(F.sum(F.when(disc, 1).otherwise(0)), F.count(F.lit(1))).alias("discount_usage_rate_pct"),
        avg_of(F.when(disc, F.col("discount_percent"))).alias("avg_discount_when_applied"),
        money(F.sum("discount_amount")).alias("total_discount_cost"),
        money(F.sum("profit")).alias("total_profit"),
        margin_pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"))
        .orderBy(F.desc("total_discount_cost"), "traffic_source"))


VIEWS = {
    "mkt_channel_performance": mkt_channel_performance,
    "mkt_channel_monthly_trend": mkt_channel_monthly_trend,
    "mkt_channel_category_matrix": mkt_channel_category_matrix,
    "mkt_channel_country_matrix": mkt_channel_country_matrix,
    "mkt_channel_new_vs_returning": mkt_channel_new_vs_returning,
    "mkt_channel_efficiency_ranking": mkt_channel_efficiency_ranking,
    "mkt_channel_discount_analysis": mkt_channel_discount_analysis,
}
