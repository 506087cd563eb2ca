"""Customer analytics: RFM scoring and segments, CLV, top customers, Pareto,
repeat purchase and cohort retention.

The per-customer profile (last order, orders, revenue ...) is computed once
in the customer dimension; RFM and CLV read it at customer grain instead of
re-aggregating order rows.  Scores over all customers use
:func:`ordered_stats`, which range-partitions above a size threshold.

RFM direction: 5 is the best score in every dimension (most recent, most
frequent, highest spend), as the segment rules require; ties are broken by
customer_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions import calendar as cal
from tillstar.functions import mappings as mp
from tillstar.functions.metrics import avg_of, big, dbl, half_up_div, money, pct, ratio
from tillstar.operators.ranking import OrderSpec, ordered_stats
from tillstar.operators.selection import ntile_cuts, order_limits, part_of
from tillstar.plans.warehouse import Warehouse

TIE = [("customer_id", False)]
# months in one word of a customer's mask
COHORT_BITS = 60
# whole numbers that rise with the score: the latest last order is best
RFM_MEASURES = {"r": "-recency_days", "f": "frequency", "m": "CAST(monetary * 100 AS BIGINT)"}


def _snapshot(wh: Warehouse) -> DataFrame:
    """One-row analysis date: last order date + 1 day."""
    return wh.dim_customer.agg(F.date_add(F.max("last_order_date"), 1).alias("_snapshot"))


def rfm_base(wh: Warehouse) -> DataFrame:
    """Recency, frequency and spend with their quintiles (NTILE over the
    measure, then the id).

    The quintiles' last customers are selected by counting value ranges; every
    customer is then scored by comparing with them, without any order."""
    base = (wh.dim_customer.crossJoin(F.broadcast(_snapshot(wh))).select(
        "customer_id", "customer_key", "customer_country",
        F.datediff("_snapshot", "last_order_date").cast("bigint").alias("recency_days"),
        big("total_orders").alias("frequency"),
        F.round("total_revenue", 2).alias("monetary")))
    limits = wh.keep("rfm_limits", lambda: order_limits(base, RFM_MEASURES, "customer_id", ntile_cuts(5)))
    return base.select("*", *[part_of(RFM_MEASURES[m], "customer_id", limits[m]).alias(f"{m}_score") for m in RFM_MEASURES])


def _rfm_out(df: DataFrame) -> DataFrame:
    return df.select(big("customer_id").alias("customer_id"), big("customer_key").alias("customer_key"),
                     "customer_country", "recency_days", "frequency", dbl("monetary").alias("monetary"),
                     "r_score", "f_score", "m_score")


def _build_rfm_segments_df(wh: Warehouse) -> DataFrame:
    b = rfm_base(wh)
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return (b.withColumn("rfm_composite_score", ratio(r + f + m, F.lit(3)))
             .withColumn("rfm_cell", F.concat(r.cast("string"), f.cast("string"), m.cast("string")))
             .withColumn("customer_segment", mp.rfm_segment(r, f, m)))


def rfm_segments_df(wh: Warehouse) -> DataFrame:
    return wh.memo("rfm_segments", lambda: _build_rfm_segments_df(wh))


def rfm_base_view(wh: Warehouse) -> DataFrame:
    return _rfm_out(rfm_base(wh))


def rfm_segments(wh: Warehouse) -> DataFrame:
    s = rfm_segments_df(wh)
    return s.select(big("customer_id").alias("customer_id"), big("customer_key").alias("customer_key"),
                    "customer_country", "recency_days", "frequency", dbl("monetary").alias("monetary"),
                    "r_score", "f_score", "m_score", "rfm_composite_score", "rfm_cell", "customer_segment")


def rfm_segment_summary(wh: Warehouse) -> DataFrame:
    s = rfm_segments_df(wh)
    g = s.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("monetary").alias("_mon"),
        avg_of("monetary").alias("avg_monetary_value"),
        avg_of("frequency").alias("avg_frequency"),
        avg_of("recency_days", 1).alias("avg_recency_days"))
    w = Window.partitionBy()  # at most eight segment rows
    return (g.select("customer_segment", big("_n").alias("customer_count"),
                     pct(F.col("_n"), F.sum("_n").over(w)).alias("pct_of_customers"),
                     "avg_monetary_value", money("_mon").alias("total_segment_revenue"),
                     pct(F.col("_mon"), F.sum("_mon").over(w)).alias("pct_of_revenue"),
                     "avg_frequency", "avg_recency_days")
             .orderBy(F.desc("total_segment_revenue"), "customer_segment"))


def clv_projection_cents(revenue: str, orders: str, life: str):
    """3-year CLV projection in exact integer cents.

    avg order value x greatest(annual frequency, 1) x 3, where annual
    frequency = orders / lifespan_days * 365 (null for a one-day customer):
    = 3c/n when the frequency is below one or undefined, else 1095c/life."""
    c = (F.col(revenue) * 100).cast("bigint")
    n, life = F.col(orders).cast("bigint"), F.col(life).cast("bigint")
    slow = life.isNull() | (life == 0) | (n * 365 < life)
    return F.when(slow, half_up_div(c * 3, n)).otherwise(half_up_div(c * 1095, life))


def _build_customer_clv_df(wh: Warehouse) -> DataFrame:
    seg = rfm_segments_df(wh).select("customer_id", F.col("customer_segment").alias("rfm_segment"))
    d = wh.dim_customer
    life = F.col("customer_lifespan_days")
    out = d.join(seg, "customer_id").select(
        big("customer_id").alias("customer_id"), "customer_country",
        big("total_orders").alias("total_orders"),
        F.round("total_revenue", 2).alias("_clv"),
        dbl(F.round("total_revenue", 2)).alias("historical_clv"),
        money("total_profit").alias("total_profit"),
        ratio("total_revenue", "total_orders").alias("avg_order_value"),
        "first_order_date", "last_order_date",
        big(life).alias("customer_lifespan_days"),
        ratio(F.col("total_orders"), F.nullif(life, F.lit(0)), 2, 365.0).alias("annual_purchase_frequency"),
        (dbl(clv_projection_cents("total_revenue", "total_orders", "customer_lifespan_days")) / 100.0)
        .alias("clv_3yr_projection"),
        mp.clv_tier_left_closed(F.col("total_revenue")).alias("clv_tier"),
        "rfm_segment")
    return out


def customer_clv_df(wh: Warehouse) -> DataFrame:
    return wh.memo("customer_clv", lambda: _build_customer_clv_df(wh))


def customer_clv(wh: Warehouse) -> DataFrame:
    return customer_clv_df(wh).drop("_clv")


def top_customers(wh: Warehouse) -> DataFrame:
    clv = customer_clv_df(wh)
    s = ordered_stats(clv, OrderSpec([("_clv", True)], TIE), rank="revenue_rank",
                      running_sums={"_cum": "_clv"}, totals={"_tot": "_clv"}, expected_rows=wh.customer_rows())
    return s.select("customer_id", "customer_country", "total_orders", "historical_clv", "total_profit",
                    "avg_order_value", "clv_tier", "rfm_segment", "revenue_rank",
                    pct(F.col("_cum"), F.col("_tot")).alias("cumulative_revenue_pct"))


def customer_pareto(wh: Warehouse) -> DataFrame:
    clv = customer_clv_df(wh).select("customer_id", "historical_clv", "_clv")
    s = ordered_stats(clv, OrderSpec([("_clv", True)], TIE), rank="revenue_rank",
                      running_sums={"_cum": "_clv"}, totals={"_tot": "_clv"}, row_count="_n",
                      expected_rows=wh.customer_rows())
    cum_pct = pct(F.col("_cum"), F.col("_tot"))
    return s.select("customer_id", "historical_clv", "revenue_rank",
                    pct(F.col("revenue_rank"), F.col("_n")).alias("customer_percentile"),
                    cum_pct.alias("cumulative_revenue_pct"),
                    F.when(cum_pct <= 80, mp.PARETO_TOP).otherwise(mp.PARETO_BOTTOM).alias("pareto_group"))


def repeat_purchase_analysis(wh: Warehouse) -> DataFrame:
    g = wh.dim_customer.groupBy("is_repeat_customer").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("total_revenue").alias("_rev"),
        avg_of("total_revenue").alias("avg_revenue_per_customer"),
        avg_of("avg_order_value").alias("avg_order_value"))
    w = Window.partitionBy()  # two rows
    return g.select("is_repeat_customer", big("_n").alias("customer_count"),
                    pct(F.col("_n"), F.sum("_n").over(w)).alias("pct_of_customers"),
                    "avg_revenue_per_customer", "avg_order_value",
                    money("_rev").alias("total_revenue_contribution"),
                    pct(F.col("_rev"), F.sum("_rev").over(w)).alias("pct_of_total_revenue"))


def _build_cohort_counts(wh: Warehouse) -> DataFrame:
    """(cohort_month, order_month) -> distinct active customers.

    One pass over the fact makes a row per customer: the months with orders as
    bits (words of 60 months, by the calendar's length), the lowest of which is
    the cohort.  The cells are sums of bits per cohort, one row a cohort."""
    ends = wh.dim_date.agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi")).first()
    if ends["lo"] is None:
        months, origin = 0, 0
    else:
        origin = ends["lo"].year * 12 + ends["lo"].month - 1
        months = ends["hi"].year * 12 + ends["hi"].month - origin
    date = cal.key_to_date(F.col("date_key"))
    at = (F.year(date) * 12 + F.month(date) - 1 - origin).cast("int")
    words = range(-(-months // COHORT_BITS) or 1)
    masks = wh.fact.select("customer_key", at.alias("at")).groupBy("customer_key").agg(
        F.min("at").alias("cohort"),
        *[F.bit_or(F.when(F.floor(F.col("at") / COHORT_BITS) == w, F.expr(
            f"shiftleft(CAST(1 AS BIGINT), pmod(at, {COHORT_BITS}))")).otherwise(F.lit(0).cast("bigint"))).alias(f"w{w}") for w in words])
    bit = lambda m: F.sum(F.shiftright(F.col(f"w{m // COHORT_BITS}"), m % COHORT_BITS).bitwiseAND(F.lit(1)))
    cells = masks.groupBy("cohort").agg(*[bit(m).alias(f"m{m}") for m in range(months)] or [F.count(F.lit(1)).alias("m0")])
    month = lambda c: F.make_date(F.floor((c + origin) / 12).cast("int"), (F.pmod(c + origin, F.lit(12)) + 1).cast("int"), F.lit(1))
    each = cells.select("cohort", F.expr(f"stack({max(1, months)}, " + ", ".join(f"{m}, m{m}" for m in range(max(1, months)))
                                         + ") AS (at, customers)")).filter("customers > 0")
    return each.select(month(F.col("cohort")).alias("cohort_month"), month(F.col("at")).alias("order_month"), "customers",
                       (F.col("at") - F.col("cohort")).alias("period_number"))


def cohort_counts(wh: Warehouse) -> DataFrame:
    return wh.memo("cohort_counts", lambda: _build_cohort_counts(wh))


def cohort_retention(wh: Warehouse) -> DataFrame:
    c = cohort_counts(wh)
    # cohorts x periods is bounded by the calendar (months squared)
    size = F.first("customers").over(Window.partitionBy("cohort_month").orderBy("period_number"))
    return (c.select("cohort_month", big("period_number").alias("period_number"), big("customers").alias("customers"),
                     big(size).alias("cohort_size"), pct(F.col("customers"), size).alias("retention_rate_pct"))
             .orderBy("cohort_month", "period_number"))


VIEWS = {
    "rfm_base": rfm_base_view,
    "rfm_segments": rfm_segments,
    "rfm_segment_summary": rfm_segment_summary,
    "customer_clv": customer_clv,
    "top_customers": top_customers,
    "customer_pareto": customer_pareto,
    "repeat_purchase_analysis": repeat_purchase_analysis,
    "cohort_retention": cohort_retention,
}
