"""Notebook analyses: the exploratory, customer and executive tables of the
pandas path, where they differ from (or add to) the SQL views.

Means are exact sums divided by counts (pandas divides the float sum);
percentages are rounded like the views.  Binning, quantile scores, tiers and
labels follow the notebook rules (left-closed discount bins, rank-based
quantile scores, right-closed CLV tiers, clipped lifespans).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions import calendar as cal
from tillstar.functions import mappings as mp
from tillstar.functions.metrics import big, dbl, half_up_div, money, orders_count, pct, ratio, snap_round
from tillstar.operators.ranking import OrderSpec, ordered_stats
from tillstar.operators.selection import order_limits, part_of
from tillstar.plans.warehouse import Warehouse, enriched


def mean(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return dbl(F.sum(c)) / F.nullif(F.count(c), F.lit(0))


def eda_monthly(wh: Warehouse) -> DataFrame:
    f = enriched(wh)
    return (f.groupBy("year", "month", "month_label").agg(
        dbl(F.sum("revenue")).alias("revenue"), dbl(F.sum("profit")).alias("profit"),
        big(orders_count()).alias("orders"))
        .select(big("year").alias("year"), big("month").alias("month"), "month_label", "revenue", "profit", "orders")
        .orderBy("year", "month"))


def eda_category(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, product=["product_category"])
    return (f.groupBy("product_category").agg(
        dbl(F.sum("revenue")).alias("revenue"), dbl(F.sum("profit")).alias("profit"),
        big(orders_count()).alias("orders"), big(F.sum("quantity")).alias("units"),
        mean("discount_percent").alias("avg_discount"), mean("is_returned").alias("return_rate"),
        pct(F.sum("profit"), F.sum("revenue")).alias("margin_pct"),
        pct(F.sum("is_returned"), F.count("is_returned")).alias("return_pct"))
        .orderBy(F.desc("revenue"), "product_category"))


def eda_country(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, country=["country_name", "region"])
    return (f.groupBy("country_name", "region").agg(
        dbl(F.sum("revenue")).alias("revenue"), dbl(F.sum("profit")).alias("profit"),
        big(orders_count()).alias("orders"), big(F.countDistinct("customer_key")).alias("customers"),
        ratio(F.sum("revenue"), orders_count()).alias("aov"),
        pct(F.sum("profit"), F.sum("revenue")).alias("margin_pct"))
        .orderBy(F.desc("revenue"), "country_name"))


def eda_channel(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, traffic_source=["traffic_source", "channel_type"])
    g = f.groupBy("traffic_source", "channel_type").agg(
        F.sum("revenue").alias("_rev"), dbl(F.sum("profit")).alias("profit"),
        big(orders_count()).alias("orders"), big(F.countDistinct("customer_key")).alias("customers"),
        mean("discount_percent").alias("avg_discount"), mean("is_returned").alias("return_rate"),
        ratio(F.sum("revenue"), orders_count()).alias("aov"),
        pct(F.sum("profit"), F.sum("revenue")).alias("margin_pct"))
    return (g.select("traffic_source", "channel_type", dbl("_rev").alias("revenue"), "profit", "orders",
                     "customers", "avg_discount", "return_rate", "aov", "margin_pct",
                     pct(F.col("_rev"), F.sum("_rev").over(Window.partitionBy()), 1).alias("rev_share"))
             .orderBy(F.desc("revenue"), "traffic_source"))


def eda_payment(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, payment_method=["payment_method"])
    return (f.groupBy("payment_method").agg(
        dbl(F.sum("revenue")).alias("revenue"), dbl(F.sum("profit")).alias("profit"),
        big(orders_count()).alias("orders"), mean("is_returned").alias("return_rate"),
        pct(F.sum("profit"), F.sum("revenue")).alias("margin_pct"),
        pct(F.sum("is_returned"), F.count("is_returned")).alias("return_pct"))
        .orderBy(F.desc("revenue"), "payment_method"))


def eda_discount_bands(wh: Warehouse) -> DataFrame:
    """Left-closed bins [0,.001) [.001,10) [10,20) [20,30) [30,40) [40,101);
    rows outside every bin are left out, empty bins are not shown."""
    pctc = F.col("discount_percent")
    f = wh.fact.withColumn("discount_band", mp.nb_discount_band(pctc)).withColumn("_ord", mp.nb_band_order(pctc))
    return (f.filter(F.col("discount_band").isNotNull()).groupBy("discount_band", "_ord").agg(
        big(orders_count()).alias("orders"), dbl(F.sum("revenue")).alias("revenue"),
        dbl(F.sum("profit")).alias("profit"), mean("rating").alias("avg_rating"),
        mean("is_returned").alias("return_rate"),
        pct(F.sum("profit"), F.sum("revenue")).alias("margin_pct"),
        pct(F.sum("is_returned"), F.count("is_returned")).alias("return_pct"))
        .orderBy("_ord").drop("_ord"))


def eda_returns(wh: Warehouse) -> DataFrame:
    f = wh.with_dims(wh.fact, product=["product_category"])
    ret, kept = F.col("is_returned") == 1, F.col("is_returned") == 0
    return (f.groupBy("product_category").agg(
        big(F.count("order_id")).alias("total"), big(F.sum("is_returned")).alias("returned"),
        dbl(F.coalesce(F.sum(F.when(ret, F.col("revenue"))), F.lit(0))).alias("rev_lost"),
        mean(F.when(ret, F.col("rating"))).alias("avg_rating_ret"),
        mean(F.when(kept, F.col("rating"))).alias("avg_rating_kept"),
        pct(F.sum("is_returned"), F.count("order_id")).alias("return_pct"))
        .orderBy(F.desc("return_pct"), "product_category"))


# --- customer notebook ------------------------------------------------------

def _build_customer_fact_profile(wh: Warehouse) -> DataFrame:
    """Per customer_key from fact rows (the notebook's groupby on the fact)."""
    return wh.fact.groupBy("customer_key").agg(
        F.max("date_key").alias("_last_key"), F.min("date_key").alias("_first_key"),
        F.count(F.lit(1)).alias("frequency"), F.sum("revenue").alias("_rev"),
        F.sum("profit").alias("_prof"))


def customer_fact_profile(wh: Warehouse) -> DataFrame:
    return wh.memo("customer_fact_profile", lambda: _build_customer_fact_profile(wh))


def qcut_score(rank_col: str, n_col: str, q: int = 5):
    """Quantile bin (1..q) of rank k among n, as ``qcut(rank(method='first'), q)``:
    max(1, ceil((k-1)*q/(n-1))) computed in integers."""
    k, n = F.col(rank_col), F.col(n_col)
    return F.when(n <= 1, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.call_function("div", (k - 1) * q + n - 2, n - 1))).cast("bigint")


def qcut_cuts(q: int = 5):
    """Last rank of every bin of ``qcut_score`` but the last."""
    def cuts(n: int) -> list:
        return [j * (n - 1) // q + 1 for j in range(1, q)]
    return cuts


QUANTILE_MEASURES = {"r": "recency_days", "f": "frequency", "m": "CAST(_mon * 100 AS BIGINT)"}


def _build_rfm_quantile_df(wh: Warehouse) -> DataFrame:
    p = customer_fact_profile(wh)
    snap = wh.fact.agg(F.date_add(cal.key_to_date(F.max("date_key")), 1).alias("_snap"))
    base = p.crossJoin(F.broadcast(snap)).select(
        "customer_key", F.datediff("_snap", cal.key_to_date(F.col("_last_key"))).cast("bigint").alias("recency_days"),
        big("frequency").alias("frequency"), F.round("_rev", 2).alias("_mon"))
    limits = order_limits(base, QUANTILE_MEASURES, "customer_key", qcut_cuts())
    r, f, m = (part_of(QUANTILE_MEASURES[x], "customer_key", limits[x]) for x in "rfm")
    r = (F.lit(6) - r).cast("bigint")
    return base.select(big("customer_key").alias("customer_key"), "recency_days", "frequency",
                       dbl("_mon").alias("monetary"), "_mon", r.alias("r_score"), f.alias("f_score"),
                       m.alias("m_score"), (r + f + m).alias("rfm_score"))


def rfm_quantile_df(wh: Warehouse) -> DataFrame:
    return wh.memo("rfm_quantile", lambda: _build_rfm_quantile_df(wh))


def rfm_quantile(wh: Warehouse) -> DataFrame:
    return rfm_quantile_df(wh).drop("_mon")


def rfm_quantile_segments(wh: Warehouse) -> DataFrame:
    s = rfm_quantile_df(wh).withColumn(
        "segment", mp.rfm_segment(F.col("r_score"), F.col("f_score"), F.col("m_score")))
    g = s.groupBy("segment").agg(
        F.count(F.lit(1)).alias("_n"), mean("recency_days").alias("avg_recency"),
        mean("frequency").alias("avg_frequency"), mean("_mon").alias("avg_monetary"),
        F.sum("_mon").alias("_tot"))
    w = Window.partitionBy()  # at most eight segments
    return (g.select("segment", big("_n").alias("customers"), "avg_recency", "avg_frequency", "avg_monetary",
                     dbl("_tot").alias("total_revenue"),
                     pct(F.col("_tot"), F.sum("_tot").over(w)).alias("revenue_pct"),
                     pct(F.col("_n"), F.sum("_n").over(w)).alias("cust_pct"))
             .orderBy(F.desc("total_revenue"), "segment"))


def _build_clv_clipped_df(wh: Warehouse) -> DataFrame:
    p = customer_fact_profile(wh)
    life = F.greatest(F.datediff(cal.key_to_date(F.col("_last_key")), cal.key_to_date(F.col("_first_key"))),
                      F.lit(1))
    p = p.withColumn("lifespan_days", life.cast("bigint"))
    cents = (F.col("_rev") * 100).cast("bigint")
    n, lf = F.col("frequency").cast("bigint"), F.col("lifespan_days")
    proj = F.when(n * 365 < lf, half_up_div(cents * 3, n)).otherwise(half_up_div(cents * 1095, lf))
    return p.select(
        big("customer_key").alias("customer_key"), big("frequency").alias("total_orders"),
        dbl("_rev").alias("total_revenue"), dbl("_prof").alias("total_profit"),
        cal.key_to_date(F.col("_first_key")).alias("first_order"),
        cal.key_to_date(F.col("_last_key")).alias("last_order"),
        (dbl("_rev") / F.col("frequency")).alias("avg_order_val"),
        "lifespan_days",
        F.greatest(dbl(n) / dbl(lf) * 365, F.lit(1.0)).alias("annual_freq"),
        (dbl(proj) / 100.0).alias("clv_3yr_proj"),
        F.round("_rev", 2).alias("_clv"),
        money("_rev").alias("historical_clv"),
        mp.clv_tier_right_closed(F.round("_rev", 2)).alias("clv_tier"))


def clv_clipped_df(wh: Warehouse) -> DataFrame:
    return wh.memo("clv_clipped", lambda: _build_clv_clipped_df(wh))


def clv_clipped(wh: Warehouse) -> DataFrame:
    return clv_clipped_df(wh).drop("_clv")


def clv_tier_summary(wh: Warehouse) -> DataFrame:
    c = clv_clipped_df(wh).filter(F.col("clv_tier").isNotNull())
    g = c.groupBy("clv_tier").agg(F.count(F.lit(1)).alias("_n"), F.sum("_clv").alias("_tot"),
                                  mean("_clv").alias("avg_clv"))
    order = F.when(F.col("clv_tier") == mp.CLV_TIERS[0], 1).when(F.col("clv_tier") == mp.CLV_TIERS[1], 2) \
        .when(F.col("clv_tier") == mp.CLV_TIERS[2], 3).otherwise(4)
    return (g.select("clv_tier", big("_n").alias("customers"), dbl("_tot").alias("total_revenue"), "avg_clv",
                     pct(F.col("_tot"), F.sum("_tot").over(Window.partitionBy())).alias("rev_pct"),
                     order.alias("_o"))
             .orderBy("_o").drop("_o"))


def top10_customer_revenue(wh: Warehouse, k: int = 10) -> DataFrame:
    c = clv_clipped_df(wh)
    top = c.orderBy(F.desc("_clv"), "customer_key").limit(k)
    return top.agg(dbl(F.sum("_clv")).alias("top10_revenue"), big(F.count(F.lit(1))).alias("customers"))


def pareto_point(wh: Warehouse) -> DataFrame:
    """Smallest share of customers (by revenue, descending) whose cumulative
    revenue reaches 80 %; compared exactly as 5 * cumulative >= 4 * total."""
    c = clv_clipped_df(wh).select("customer_key", "_clv")
    s = ordered_stats(c, OrderSpec([("_clv", True)], [("customer_key", False)]), row_number="_rn",
                      running_sums={"_cum": "_clv"}, totals={"_tot": "_clv"}, row_count="_n",
                      expected_rows=wh.customer_rows())
    hit = s.filter(F.col("_cum") * 5 >= F.col("_tot") * 4)
    return hit.agg(big(F.min("_rn")).alias("customers_to_80pct"), big(F.first("_n")).alias("total_customers")) \
        .select("customers_to_80pct", "total_customers",
                (dbl("customers_to_80pct") / dbl("total_customers") * 100).alias("pct_customers_80"))


def cohort_matrix(wh: Warehouse, periods: int = 12) -> DataFrame:
    """Cohort x period retention, zero-filled, as % of period 0 (rounded to
    3 decimals before scaling), first ``periods`` periods."""
    from tillstar.plans.customer import cohort_counts
    c = cohort_counts(wh).filter(F.col("period_number") < periods)
    piv = c.groupBy("cohort_month").pivot("period_number", list(range(periods))).agg(F.first("customers"))
    piv = piv.na.fill(0)
    base = F.col("0")
    cols = [(snap_round(dbl(F.col(str(p))) / F.nullif(dbl(base), F.lit(0.0)), 3) * 100.0).alias(f"period_{p}")
            for p in range(periods)]
    return piv.select("cohort_month", *cols).orderBy("cohort_month")


def repeat_summary(wh: Warehouse) -> DataFrame:
    c = clv_clipped_df(wh).withColumn("is_repeat", F.col("total_orders") > 1)
    return (c.groupBy("is_repeat").agg(
        big(F.count(F.lit(1))).alias("customers"), dbl(F.sum("_clv")).alias("total_revenue"),
        mean("_clv").alias("avg_revenue"), mean("total_orders").alias("avg_orders"))
        .withColumn("label", F.when(F.col("is_repeat"), mp.REPEAT_LABEL).otherwise(mp.ONE_TIME_LABEL))
        .orderBy("is_repeat"))


def exec_kpis(wh: Warehouse) -> DataFrame:
    f = wh.fact
    return f.agg(
        dbl(F.sum("revenue")).alias("total_revenue"), dbl(F.sum("profit")).alias("total_profit"),
        big(orders_count()).alias("total_orders"), big(F.countDistinct("customer_key")).alias("total_customers"),
        (dbl(F.sum("revenue")) / orders_count()).alias("aov"),
        (dbl(F.sum("profit")) / dbl(F.sum("revenue")) * 100).alias("margin_pct"),
        (dbl(F.sum("is_returned")) / F.count("is_returned") * 100).alias("return_rate_pct"),
        (dbl(F.sum("discount_amount")) / dbl(F.sum("gross_revenue")) * 100).alias("discount_rate_pct"))


def revenue_drivers(wh: Warehouse) -> DataFrame:
    """Revenue by category, by channel and by country in ONE scan with
    GROUPING SETS; ``driver`` names the grouping."""
    f = wh.with_dims(wh.fact, product=["product_category"], traffic_source=["traffic_source"],
                     country=["country_name"])
    g = f.groupingSets([["product_category"], ["traffic_source"], ["country_name"]],
                       "product_category", "traffic_source", "country_name") \
        .agg(dbl(F.sum("revenue")).alias("revenue"),
             F.grouping_id("product_category", "traffic_source", "country_name").alias("_gid"))
    driver = F.when(F.col("_gid") == 3, "category").when(F.col("_gid") == 5, "channel").otherwise("country")
    member = F.coalesce("product_category", "traffic_source", "country_name")
    return (g.select(driver.alias("driver"), member.alias("member"), "revenue")
             .orderBy("driver", F.desc("revenue"), "member"))


def margin_drivers(wh: Warehouse) -> DataFrame:
    """Revenue, profit, margin % by category and by channel; flags margins at
    or above the unweighted mean of the (rounded) margins of that driver."""
    f = wh.with_dims(wh.fact, product=["product_category"], traffic_source=["traffic_source"])
    g = f.groupingSets([["product_category"], ["traffic_source"]], "product_category", "traffic_source") \
        .agg(F.sum("revenue").alias("_rev"), F.sum("profit").alias("_prof"),
             F.grouping_id("product_category", "traffic_source").alias("_gid"))
    g = g.select(F.when(F.col("_gid") == 1, "category").otherwise("channel").alias("driver"),
                 F.coalesce("product_category", "traffic_source").alias("member"),
                 dbl("_rev").alias("revenue"), dbl("_prof").alias("profit"),
                 pct(F.col("_prof"), F.col("_rev")).cast("decimal(12,2)").alias("_m"))
    w = Window.partitionBy("driver")  # a handful of rows per driver
    return (g.select("driver", "member", "revenue", "profit", dbl("_m").alias("margin_pct"),
                     ratio(F.sum("_m").over(w), F.count("_m").over(w), 4).alias("avg_margin_pct"),
                     (F.col("_m") * F.count("_m").over(w) >= F.sum("_m").over(w)).alias("above_average"))
             .orderBy("driver", "margin_pct", "member"))


def leakage_amounts(wh: Warehouse) -> DataFrame:
    f = wh.fact
    a = f.agg(
        F.coalesce(F.sum(F.when(F.col("discount_percent") > 30, F.col("discount_amount"))), F.lit(0)).alias("a"),
        F.coalesce(F.sum(F.when(F.col("is_returned") == 1, F.col("profit"))), F.lit(0)).alias("b"),
        F.coalesce(F.sum(F.when(F.col("rating") <= 2.0, F.col("profit"))), F.lit(0)).alias("c"))
    s = a.select(dbl("a").alias("a"), dbl("b").alias("b"), dbl("c").alias("c")).selectExpr(
        f"stack(3, '{mp.NB_LEAK_DISCOUNT}', a, '{mp.NB_LEAK_RETURNS}', b, "
        f"'{mp.NB_LEAK_LOW_RATING}', c) AS (leakage_type, profit_impact)")
    return s.withColumn("abs_impact", F.abs("profit_impact"))


def top10_customers_nb(wh: Warehouse, k: int = 10) -> DataFrame:
    agg = wh.fact.groupBy("customer_key").agg(
        F.sum("revenue").alias("_rev"), F.sum("profit").alias("_prof"), F.count(F.lit(1)).alias("orders"))
    top = agg.orderBy(F.desc("_rev"), "customer_key").limit(k) \
        .join(wh.dim("customer", "customer_country"), "customer_key")
    return (top.select(
        big("customer_key").alias("customer_key"), "customer_country", big("orders").alias("orders"),
        dbl("_rev").alias("revenue"), dbl("_prof").alias("profit"),
        pct(F.col("_prof"), F.col("_rev"), 1).alias("margin_pct"),
        F.concat(F.lit("$"), F.format_number(F.round("_rev", 2), 2)).alias("revenue_display"),
        F.concat(F.lit("$"), F.format_number(F.round("_prof", 2), 2)).alias("profit_display"),
        F.col("_rev"))
        .orderBy(F.desc("_rev"), "customer_key").drop("_rev"))


VIEWS = {
    "eda_monthly": eda_monthly,
    "eda_category": eda_category,
    "eda_country": eda_country,
    "eda_channel": eda_channel,
    "eda_payment": eda_payment,
    "eda_discount_bands": eda_discount_bands,
    "eda_returns": eda_returns,
    "rfm_quantile": rfm_quantile,
    "rfm_quantile_segments": rfm_quantile_segments,
    "clv_clipped": clv_clipped,
    "clv_tier_summary": clv_tier_summary,
    "top10_customer_revenue": top10_customer_revenue,
    "pareto_point": pareto_point,
    "cohort_matrix": cohort_matrix,
    "repeat_summary": repeat_summary,
    "exec_kpis": exec_kpis,
    "revenue_drivers": revenue_drivers,
    "margin_drivers": margin_drivers,
    "leakage_amounts": leakage_amounts,
    "top10_customers_nb": top10_customers_nb,
}
