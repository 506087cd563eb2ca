"""KPI views over the star (fact joined to one dimension, grouped)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions import mappings as mp
from tillstar.functions.metrics import (avg_of, big, dbl, margin_pct, money, orders_count, pct, ratio, return_rate_pct)
from tillstar.plans import periods
from tillstar.plans.warehouse import Warehouse


def kpi_business_summary(wh: Warehouse) -> DataFrame:
    return periods.roll_up(wh).select(
        periods.orders().alias("total_orders"),
        big("customers").alias("total_customers"),
        dbl("revenue").alias("total_revenue"),
        dbl("gross_revenue").alias("total_gross_revenue"),
        dbl("profit").alias("total_profit"),
        dbl("discount_amount").alias("total_discount_given"),
        dbl("shipping_cost").alias("total_shipping_cost"),
        periods.per_order("revenue").alias("average_order_value"),
        margin_pct(F.col("profit"), F.col("revenue")).alias("overall_profit_margin_pct"),
        pct("discount_amount", "gross_revenue").alias("overall_discount_rate_pct"),
        pct("is_returned", "orders").alias("return_rate_pct"),
        periods.day("first_key").alias("data_start_date"),
        periods.day("last_key").alias("data_end_date"))


def kpi_monthly_revenue(wh: Warehouse) -> DataFrame:
    return (periods.roll_up(wh, "year", "month", "month_label", "quarter_label")
            .select(big("year").alias("year"), big("month").alias("month"), "month_label", "quarter_label",
                    periods.orders().alias("orders"), big("customers").alias("unique_customers"),
                    money("revenue").alias("revenue"), money("gross_revenue").alias("gross_revenue"),
                    periods.per_order("revenue").alias("aov"))
            .orderBy("year", "month"))


def kpi_quarterly_revenue(wh: Warehouse) -> DataFrame:
    return (periods.roll_up(wh, "year", "quarter", "quarter_label")
            .select(big("year").alias("year"), big("quarter").alias("quarter"), "quarter_label",
                    money("revenue").alias("revenue"), money("profit").alias("profit"),
                    periods.orders().alias("orders"),
                    margin_pct(F.col("profit"), F.col("revenue")).alias("profit_margin_pct"))
            .orderBy("year", "quarter"))


def kpi_annual_revenue(wh: Warehouse) -> DataFrame:
    return (periods.roll_up(wh, "year")
            .select(big("year").alias("year"), money("revenue").alias("revenue"), money("profit").alias("profit"),
                    periods.orders().alias("orders"), big("customers").alias("customers"),
                    periods.per_order("revenue").alias("aov"),
                    margin_pct(F.col("profit"), F.col("revenue")).alias("profit_margin_pct"))
            .orderBy("year"))


def kpi_profit_by_category(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, product=["product_category"])
    return (f.groupBy("product_category").agg(
        big(orders_count()).alias("orders"),
        big(F.sum("quantity")).alias("units_sold"),
        money(F.sum("revenue")).alias("revenue"),
        money(F.sum("profit")).alias("profit"),
        margin_pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"),
        avg_of("discount_percent").alias("avg_discount_pct"),
        return_rate_pct().alias("return_rate_pct"))
        .orderBy(F.desc("profit"), "product_category"))


def kpi_aov_by_channel(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, traffic_source=["traffic_source", "channel_type", "is_paid"])
    return (f.groupBy("traffic_source", "channel_type", "is_paid").agg(
        big(orders_count()).alias("orders"),
        money(F.sum("revenue")).alias("total_revenue"),
        ratio(F.sum("revenue"), orders_count()).alias("aov"),
        margin_pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"))
        .orderBy(F.desc("aov"), "traffic_source"))


def kpi_return_rate(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, product=["product_category"])
    ret = F.col("is_returned") == 1
    kept = F.col("is_returned") == 0
    return (f.groupBy("product_category").agg(
        big(orders_count()).alias("total_orders"),
        big(F.sum("is_returned")).alias("returned_orders"),
        return_rate_pct().alias("return_rate_pct"),
        money(F.sum(F.when(ret, F.col("revenue")).otherwise(F.lit(0)))).alias("returned_revenue"),
        avg_of(F.when(ret, F.col("rating"))).alias("avg_rating_returned"),
        avg_of(F.when(kept, F.col("rating"))).alias("avg_rating_kept"))
        .orderBy(F.desc("return_rate_pct"), "product_category"))


def kpi_discount_impact(wh: Warehouse) -> DataFrame:
    """Bands on whole percentages; ordered by the smallest discount in band."""
    f = wh.fact.withColumn("discount_band", mp.kpi_discount_band(F.col("discount_percent")))
    return (f.groupBy("discount_band").agg(
        big(orders_count()).alias("orders"),
        money(F.sum("revenue")).alias("revenue"),
        money(F.sum("profit")).alias("profit"),
        money(F.sum("discount_amount")).alias("total_discount_given"),
        margin_pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"),
        avg_of("rating").alias("avg_rating"),
        return_rate_pct().alias("return_rate_pct"),
        F.min("discount_percent").alias("_min_pct"))
        .orderBy("_min_pct").drop("_min_pct"))


def kpi_country_performance(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, country=["country_name", "region"])
    return (f.groupBy("country_name", "region").agg(
        big(orders_count()).alias("orders"),
        big(F.countDistinct("customer_key")).alias("customers"),
        money(F.sum("revenue")).alias("revenue"),
        money(F.sum("profit")).alias("profit"),
        ratio(F.sum("revenue"), orders_count()).alias("aov"),
        margin_pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"),
        return_rate_pct().alias("return_rate_pct"))
        .orderBy(F.desc("revenue"), "country_name"))


def kpi_payment_performance(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, payment_method=["payment_method", "payment_type", "is_digital_wallet"])
    return (f.groupBy("payment_method", "payment_type", "is_digital_wallet").agg(
        big(orders_count()).alias("orders"),
        money(F.sum("revenue")).alias("revenue"),
        ratio(F.sum("revenue"), orders_count()).alias("aov"),
        margin_pct(F.sum("profit"), F.sum("revenue")).alias("profit_margin_pct"),
        return_rate_pct().alias("return_rate_pct"))
        .orderBy(F.desc("revenue"), "payment_method"))


VIEWS = {
    "kpi_business_summary": kpi_business_summary,
    "kpi_monthly_revenue": kpi_monthly_revenue,
    "kpi_quarterly_revenue": kpi_quarterly_revenue,
    "kpi_annual_revenue": kpi_annual_revenue,
    "kpi_profit_by_category": kpi_profit_by_category,
    "kpi_aov_by_channel": kpi_aov_by_channel,
    "kpi_return_rate": kpi_return_rate,
    "kpi_discount_impact": kpi_discount_impact,
    "kpi_country_performance": kpi_country_performance,
    "kpi_payment_performance": kpi_payment_performance,
}
