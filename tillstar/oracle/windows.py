"""Oracle SQL for the trend and ranking reports (ties broken by natural key).

Neighbouring months are joined on their number in the series instead of read
from a lag, and running figures are sums over joined months."""

from tillstar.oracle import big, dbl, grouped, money, pct, q, ratio, snap

SERIES = """
, series AS (
  SELECT year, month, month_label, sum(revenue) AS r, sum(profit) AS p, count(*) AS n,
         dense_rank() OVER (ORDER BY year, month) AS i
  FROM sold GROUP BY year, month, month_label
)"""
MONTH = f"{big('m.year')} AS year, {big('m.month')} AS month, m.month_label"


def shifted(name: str, by: int) -> str:
    return f"LEFT JOIN series {name} ON {name}.i = m.i + ({by})"


def of_months(value: str, when: str) -> str:
    """A value of the months x that stand in a relation to month m."""
    return f"(SELECT {value} FROM series x WHERE {when})"


YEAR_SO_FAR = "x.year = m.year AND x.month <= m.month"
THREE = "x.i BETWEEN m.i - 2 AND m.i"
FIRST = of_months("arg_min(x.r, x.month)", "x.year = m.year")
LAST = of_months("arg_max(x.r, x.month)", "x.year = m.year")
MEAN = ratio(of_months("sum(x.r)", "true"), of_months("count(*)", "true"))

IN_CATEGORY = {
    "category_revenue": "revenue", "category_profit": "profit",
    "row_num_in_category": big("row_number() OVER (PARTITION BY product_category ORDER BY sum(revenue) DESC, product_key)"),
}

SQL = {
    "win_product_row_number": grouped("product_category product_key product_id", **IN_CATEGORY),
    "win_top_product_per_category": grouped(
        "product_category product_key product_id",
        tail="QUALIFY row_number() OVER (PARTITION BY product_category ORDER BY sum(revenue) DESC, product_key) = 1",
        **IN_CATEGORY),
    "win_customer_leaderboard": q(f"""
, spent AS (
  SELECT customer_id, c.customer_country, sum(revenue) AS r, sum(profit) AS p, count(*) AS n
  FROM sold JOIN latest c USING (customer_id) GROUP BY customer_id, c.customer_country
)
SELECT {big("customer_id")} AS customer_id, customer_country, {dbl("r")} AS total_revenue, {dbl("p")} AS total_profit,
       {big("n")} AS orders, {big("1 + (SELECT count(*) FROM spent o WHERE o.r > s.r)")} AS revenue_rank,
       {big("1 + (SELECT count(DISTINCT o.r) FROM spent o WHERE o.r > s.r)")} AS revenue_dense_rank,
       {big("1 + (SELECT count(*) FROM spent o WHERE o.r > s.r AND o.customer_country = s.customer_country)")}
         AS country_revenue_rank
FROM (SELECT * FROM spent ORDER BY r DESC, customer_id LIMIT 50) s"""),
    "win_mom_yoy_growth": q(SERIES + f"""
SELECT {MONTH}, {dbl("m.r")} AS revenue, {dbl("m.p")} AS profit, {big("m.n")} AS orders,
       {dbl("b.r")} AS prev_month_revenue, {money("m.r - b.r")} AS mom_revenue_change,
       {pct("m.r - b.r", "b.r")} AS mom_revenue_growth_pct, {dbl("y.r")} AS prev_year_same_month_revenue,
       {pct("m.r - y.r", "y.r")} AS yoy_revenue_growth_pct
FROM series m {shifted("b", -1)} {shifted("y", -12)}"""),
    "win_lead_trend": q(SERIES + f"""
SELECT {MONTH}, {dbl("m.r")} AS current_revenue, {dbl("a.r")} AS next_month_revenue,
       {money("m.r - a.r")} AS revenue_gap_to_next,
       CASE sign(a.r - m.r) WHEN 1 THEN 'Upward trend expected' WHEN -1 THEN 'Downward trend expected'
            ELSE 'Flat' END AS trend_signal
FROM series m {shifted("a", 1)}"""),
    "win_running_totals": q(SERIES + f"""
SELECT {MONTH}, {dbl("m.r")} AS monthly_revenue, {dbl("m.p")} AS monthly_profit,
       {dbl(of_months("sum(x.r)", YEAR_SO_FAR))} AS ytd_revenue, {dbl(of_months("sum(x.p)", YEAR_SO_FAR))} AS ytd_profit,
       {dbl(of_months("sum(x.r)", "x.i <= m.i"))} AS all_time_cumulative_revenue,
       {pct(of_months("sum(x.r)", YEAR_SO_FAR), of_months("sum(x.r)", "x.year = m.year"))} AS ytd_pct_of_annual
FROM series m"""),
    "win_moving_average": q(SERIES + f"""
SELECT {MONTH}, {dbl("m.r")} AS monthly_revenue, {dbl("m.p")} AS monthly_profit,
       {ratio(of_months("sum(x.r)", THREE), of_months("count(*)", THREE))} AS rolling_3m_avg_revenue,
       {ratio(of_months("sum(x.p)", THREE), of_months("count(*)", THREE))} AS rolling_3m_avg_profit,
       {MEAN} AS overall_avg_monthly_revenue,
       CASE WHEN m.r * {of_months("count(*)", "true")} <= {of_months("sum(x.r)", "true")} THEN 'Below Average'
            ELSE 'Above Average' END AS vs_avg_signal
FROM series m"""),
    "win_product_quartiles": q(f"""
, made AS (
  SELECT product_id, product_category, sum(revenue) AS r, sum(profit) AS p, count(*) AS n,
         {pct("sum(profit)", "sum(revenue)")} AS margin
  FROM sold GROUP BY product_id, product_category
), placed AS (
  SELECT *, ntile(4) OVER (ORDER BY r DESC, product_id, product_category) AS by_revenue,
         ntile(4) OVER (ORDER BY margin DESC NULLS LAST, product_id, product_category) AS by_margin,
         (rank() OVER (ORDER BY r DESC) - 1) / greatest(CAST(count(*) OVER () - 1 AS DOUBLE), 1) AS place
  FROM made
)
SELECT {big("product_id")} AS product_id, product_category, {dbl("r")} AS total_revenue, {dbl("p")} AS total_profit,
       margin AS margin_pct, {big("n")} AS orders, {snap("place", 4)} AS revenue_percent_rank,
       {big("by_revenue")} AS revenue_quartile, {big("by_margin")} AS margin_quartile,
       ['Top Performer', 'Strong Performer', 'Average Performer', 'Underperformer'][by_revenue] AS performance_tier
FROM placed"""),
    "win_year_baseline": q(SERIES + f"""
SELECT {MONTH}, {dbl("m.r")} AS revenue, {dbl(FIRST)} AS year_start_revenue, {dbl(LAST)} AS year_end_revenue,
       {pct("m.r - " + FIRST, FIRST)} AS growth_vs_year_start_pct
FROM series m"""),
}
