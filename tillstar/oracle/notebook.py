"""Oracle SQL for the notebook analyses."""

from tillstar.oracle import big, dbl, money, pct, q, ratio, snap


def mean(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0)"


def kdate(k: str) -> str:
    return f"CAST(strptime(CAST({k} AS VARCHAR), '%Y%m%d') AS DATE)"


ENR = """
, enr AS (
  SELECT fs.*, dd.year, dd.month, dd.month_label, dd.quarter_label, dp.product_category,
         dco.country_name, dco.region, dts.traffic_source, dts.channel_type, dts.is_paid, dpm.payment_method
  FROM fact_sales fs
  JOIN dim_date dd ON fs.date_key = dd.date_key
  JOIN dim_product dp ON fs.product_key = dp.product_key
  JOIN dim_country dco ON fs.country_key = dco.country_key
  JOIN dim_traffic_source dts ON fs.traffic_source_key = dts.traffic_source_key
  JOIN dim_payment_method dpm ON fs.payment_method_key = dpm.payment_method_key
)"""

CUST = """
, cprof AS (
  SELECT customer_key, MAX(date_key) AS last_key, MIN(date_key) AS first_key,
         COUNT(DISTINCT order_id) AS frequency, SUM(revenue) AS rev, SUM(profit) AS prof
  FROM fact_sales GROUP BY customer_key
), rfm0 AS (
  SELECT customer_key,
         date_diff('day', """ + kdate("last_key") + """,
                   (SELECT """ + kdate("MAX(date_key)") + """ + INTERVAL 1 DAY FROM fact_sales)) AS recency_days,
         frequency, ROUND(rev, 2) AS monetary
  FROM cprof
), rfm1 AS (
  SELECT *, COUNT(*) OVER () AS n,
         ROW_NUMBER() OVER (ORDER BY recency_days, customer_key) AS kr,
         ROW_NUMBER() OVER (ORDER BY frequency, customer_key) AS kf,
         ROW_NUMBER() OVER (ORDER BY monetary, customer_key) AS km
  FROM rfm0
), rfmq AS (
  SELECT customer_key, recency_days, frequency, monetary,
         6 - CASE WHEN n <= 1 THEN 1 ELSE GREATEST(1, ((kr - 1) * 5 + n - 2) // (n - 1)) END AS r_score,
         CASE WHEN n <= 1 THEN 1 ELSE GREATEST(1, ((kf - 1) * 5 + n - 2) // (n - 1)) END AS f_score,
         CASE WHEN n <= 1 THEN 1 ELSE GREATEST(1, ((km - 1) * 5 + n - 2) // (n - 1)) END AS m_score
  FROM rfm1
), clv AS (
  SELECT customer_key, frequency AS total_orders, rev, prof,
         """ + kdate("first_key") + """ AS first_order, """ + kdate("last_key") + """ AS last_order,
         GREATEST(date_diff('day', """ + kdate("first_key") + """, """ + kdate("last_key") + """), 1) AS lifespan_days,
         ROUND(rev, 2) AS hclv
  FROM cprof
), clv2 AS (
  SELECT *,
         CASE WHEN total_orders * 365 < lifespan_days
              THEN (2 * CAST(rev * 100 AS BIGINT) * 3 + total_orders) // (2 * total_orders)
              ELSE (2 * CAST(rev * 100 AS BIGINT) * 1095 + lifespan_days) // (2 * lifespan_days) END AS proj_cents,
         CASE WHEN hclv <= 0 THEN NULL WHEN hclv <= 1000 THEN 'Bronze' WHEN hclv <= 5000 THEN 'Silver'
              WHEN hclv <= 10000 THEN 'Gold' WHEN hclv IS NOT NULL THEN 'Platinum' END AS clv_tier
  FROM clv
)"""

_SEG = """CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
              WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
              WHEN r_score >= 4 AND f_score <= 2 THEN 'Potential Loyalists'
              WHEN r_score >= 3 AND f_score >= 3 AND m_score <= 2 THEN 'Promising'
              WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN 'At Risk'
              WHEN r_score = 1 AND f_score >= 2 THEN 'Lost Customers'
              WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Hibernating'
              ELSE 'Need Attention' END"""

_BAND = """CASE WHEN discount_percent >= 0 AND discount_percent < 0.001 THEN 'No Discount'
            WHEN discount_percent >= 0.001 AND discount_percent < 10 THEN '1-10%'
            WHEN discount_percent >= 10 AND discount_percent < 20 THEN '11-20%'
            WHEN discount_percent >= 20 AND discount_percent < 30 THEN '21-30%'
            WHEN discount_percent >= 30 AND discount_percent < 40 THEN '31-40%'
            WHEN discount_percent >= 40 AND discount_percent < 101 THEN '40%+' END"""

_COHORT = """
, cohort_base AS (
  SELECT customer_id, CAST(date_trunc('month', MIN(order_date)) AS DATE) AS cohort_month FROM clean GROUP BY customer_id
), cohort_data AS (
  SELECT cb.cohort_month,
         (year(om.order_month) - year(cb.cohort_month)) * 12 + (month(om.order_month) - month(cb.cohort_month)) AS p,
         COUNT(DISTINCT om.customer_id) AS customers
  FROM cohort_base cb
  JOIN (SELECT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS order_month FROM clean) om
    ON cb.customer_id = om.customer_id
  GROUP BY cb.cohort_month, om.order_month
), cohort_wide AS (
  SELECT cohort_month, """ + ",\n         ".join(
    f"COALESCE(MAX(CASE WHEN p = {i} THEN customers END), 0) AS c{i}" for i in range(12)) + """
  FROM cohort_data GROUP BY cohort_month
)"""

SQL = {
    "eda_monthly": q(ENR + f"""
SELECT {big("year")} AS year, {big("month")} AS month, month_label, {dbl("SUM(revenue)")} AS revenue,
       {dbl("SUM(profit)")} AS profit, {big("COUNT(DISTINCT order_id)")} AS orders
FROM enr GROUP BY year, month, month_label ORDER BY year, month"""),

    "eda_category": q(ENR + f"""
SELECT product_category, {dbl("SUM(revenue)")} AS revenue, {dbl("SUM(profit)")} AS profit,
       {big("COUNT(DISTINCT order_id)")} AS orders, {big("SUM(quantity)")} AS units,
       {mean("discount_percent")} AS avg_discount, {mean("is_returned")} AS return_rate,
       {pct("SUM(profit)", "SUM(revenue)")} AS margin_pct,
       {pct("SUM(is_returned)", "COUNT(is_returned)")} AS return_pct
FROM enr GROUP BY product_category ORDER BY revenue DESC"""),

    "eda_country": q(ENR + f"""
SELECT country_name, region, {dbl("SUM(revenue)")} AS revenue, {dbl("SUM(profit)")} AS profit,
       {big("COUNT(DISTINCT order_id)")} AS orders, {big("COUNT(DISTINCT customer_key)")} AS customers,
       {ratio("SUM(revenue)", "COUNT(DISTINCT order_id)")} AS aov,
       {pct("SUM(profit)", "SUM(revenue)")} AS margin_pct
FROM enr GROUP BY country_name, region ORDER BY revenue DESC"""),

    "eda_channel": q(ENR + f"""
SELECT traffic_source, channel_type, {dbl("SUM(revenue)")} AS revenue, {dbl("SUM(profit)")} AS profit,
       {big("COUNT(DISTINCT order_id)")} AS orders, {big("COUNT(DISTINCT customer_key)")} AS customers,
       {mean("discount_percent")} AS avg_discount, {mean("is_returned")} AS return_rate,
       {ratio("SUM(revenue)", "COUNT(DISTINCT order_id)")} AS aov,
       {pct("SUM(profit)", "SUM(revenue)")} AS margin_pct,
       {pct("SUM(revenue)", "SUM(SUM(revenue)) OVER ()", 1)} AS rev_share
FROM enr GROUP BY traffic_source, channel_type ORDER BY revenue DESC"""),

    "eda_payment": q(ENR + f"""
SELECT payment_method, {dbl("SUM(revenue)")} AS revenue, {dbl("SUM(profit)")} AS profit,
       {big("COUNT(DISTINCT order_id)")} AS orders, {mean("is_returned")} AS return_rate,
       {pct("SUM(profit)", "SUM(revenue)")} AS margin_pct,
       {pct("SUM(is_returned)", "COUNT(is_returned)")} AS return_pct
FROM enr GROUP BY payment_method ORDER BY revenue DESC"""),

    "eda_discount_bands": q(f"""
SELECT discount_band, {big("COUNT(DISTINCT order_id)")} AS orders, {dbl("SUM(revenue)")} AS revenue,
       {dbl("SUM(profit)")} AS profit, {mean("rating")} AS avg_rating, {mean("is_returned")} AS return_rate,
       {pct("SUM(profit)", "SUM(revenue)")} AS margin_pct,
       {pct("SUM(is_returned)", "COUNT(is_returned)")} AS return_pct
FROM (SELECT *, {_BAND} AS discount_band FROM fact_sales) b
WHERE discount_band IS NOT NULL GROUP BY discount_band ORDER BY MIN(discount_percent)"""),

    "eda_returns": q(ENR + f"""
SELECT product_category, {big("COUNT(order_id)")} AS total, {big("SUM(is_returned)")} AS returned,
       {dbl("COALESCE(SUM(CASE WHEN is_returned = 1 THEN revenue END), 0)")} AS rev_lost,
       {mean("CASE WHEN is_returned = 1 THEN rating END")} AS avg_rating_ret,
       {mean("CASE WHEN is_returned = 0 THEN rating END")} AS avg_rating_kept,
       {pct("SUM(is_returned)", "COUNT(order_id)")} AS return_pct
FROM enr GROUP BY product_category ORDER BY return_pct DESC"""),

    "rfm_quantile": q(CUST + f"""
SELECT {big("customer_key")} AS customer_key, {big("recency_days")} AS recency_days, {big("frequency")} AS frequency,
       {dbl("monetary")} AS monetary, {big("r_score")} AS r_score, {big("f_score")} AS f_score,
       {big("m_score")} AS m_score, {big("r_score + f_score + m_score")} AS rfm_score
FROM rfmq"""),

    "rfm_quantile_segments": q(CUST + f"""
, seg AS (SELECT *, {_SEG} AS segment FROM rfmq)
SELECT segment, {big("COUNT(*)")} AS customers, {mean("recency_days")} AS avg_recency,
       {mean("frequency")} AS avg_frequency, {mean("monetary")} AS avg_monetary,
       {dbl("SUM(monetary)")} AS total_revenue,
       {pct("SUM(monetary)", "SUM(SUM(monetary)) OVER ()")} AS revenue_pct,
       {pct("COUNT(*)", "SUM(COUNT(*)) OVER ()")} AS cust_pct
FROM seg GROUP BY segment ORDER BY total_revenue DESC"""),

    "clv_clipped": q(CUST + f"""
SELECT {big("customer_key")} AS customer_key, {big("total_orders")} AS total_orders, {dbl("rev")} AS total_revenue,
       {dbl("prof")} AS total_profit, first_order, last_order,
       CAST(rev AS DOUBLE) / total_orders AS avg_order_val,
       {big("lifespan_days")} AS lifespan_days,
       GREATEST(CAST(total_orders AS DOUBLE) / CAST(lifespan_days AS DOUBLE) * 365, 1.0) AS annual_freq,
       CAST(proj_cents AS DOUBLE) / 100 AS clv_3yr_proj,
       {money("rev")} AS historical_clv, clv_tier
FROM clv2"""),

    "clv_tier_summary": q(CUST + f"""
SELECT clv_tier, {big("COUNT(*)")} AS customers, {dbl("SUM(hclv)")} AS total_revenue, {mean("hclv")} AS avg_clv,
       {pct("SUM(hclv)", "SUM(SUM(hclv)) OVER ()")} AS rev_pct
FROM clv2 WHERE clv_tier IS NOT NULL GROUP BY clv_tier"""),

    "top10_customer_revenue": q(CUST + f"""
SELECT {dbl("SUM(hclv)")} AS top10_revenue, {big("COUNT(*)")} AS customers
FROM (SELECT hclv FROM clv2 ORDER BY hclv DESC, customer_key LIMIT 10)"""),

    "pareto_point": q(CUST + f"""
, cum AS (
  SELECT ROW_NUMBER() OVER (ORDER BY hclv DESC, customer_key) AS rn,
         SUM(hclv) OVER (ORDER BY hclv DESC, customer_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c,
         SUM(hclv) OVER () AS t, COUNT(*) OVER () AS n
  FROM clv2
)
SELECT {big("MIN(rn)")} AS customers_to_80pct, {big("MIN(n)")} AS total_customers,
       CAST(MIN(rn) AS DOUBLE) / CAST(MIN(n) AS DOUBLE) * 100 AS pct_customers_80
FROM cum WHERE c * 5 >= t * 4"""),

    "cohort_matrix": q(_COHORT + """
SELECT cohort_month, """ + ",\n       ".join(
        snap(f"CAST(c{i} AS DOUBLE) / NULLIF(CAST(c0 AS DOUBLE), 0)", 3) + f" * 100.0 AS period_{i}"
        for i in range(12)) + """
FROM cohort_wide ORDER BY cohort_month"""),

    "repeat_summary": q(CUST + f"""
SELECT total_orders > 1 AS is_repeat, {big("COUNT(*)")} AS customers, {dbl("SUM(hclv)")} AS total_revenue,
       {mean("hclv")} AS avg_revenue, {mean("total_orders")} AS avg_orders,
       CASE WHEN total_orders > 1 THEN 'Repeat Customers' ELSE 'One-Time Buyers' END AS label
FROM clv2 GROUP BY total_orders > 1, CASE WHEN total_orders > 1 THEN 'Repeat Customers' ELSE 'One-Time Buyers' END"""),

    "exec_kpis": q(f"""
SELECT {dbl("SUM(revenue)")} AS total_revenue, {dbl("SUM(profit)")} AS total_profit,
       {big("COUNT(DISTINCT order_id)")} AS total_orders, {big("COUNT(DISTINCT customer_key)")} AS total_customers,
       CAST(SUM(revenue) AS DOUBLE) / COUNT(DISTINCT order_id) AS aov,
       CAST(SUM(profit) AS DOUBLE) / CAST(SUM(revenue) AS DOUBLE) * 100 AS margin_pct,
       CAST(SUM(is_returned) AS DOUBLE) / COUNT(is_returned) * 100 AS return_rate_pct,
       CAST(SUM(discount_amount) AS DOUBLE) / CAST(SUM(gross_revenue) AS DOUBLE) * 100 AS discount_rate_pct
FROM fact_sales"""),

    "revenue_drivers": q(ENR + f"""
SELECT 'category' AS driver, product_category AS member, {dbl("SUM(revenue)")} AS revenue FROM enr GROUP BY 2
UNION ALL
SELECT 'channel', traffic_source, {dbl("SUM(revenue)")} FROM enr GROUP BY 2
UNION ALL
SELECT 'country', country_name, {dbl("SUM(revenue)")} FROM enr GROUP BY 2
ORDER BY 1, 3 DESC"""),

    "margin_drivers": q(ENR + f"""
, g AS (
  SELECT 'category' AS driver, product_category AS member, SUM(revenue) AS rev, SUM(profit) AS prof FROM enr GROUP BY 2
  UNION ALL
  SELECT 'channel', traffic_source, SUM(revenue), SUM(profit) FROM enr GROUP BY 2
), m AS (
  SELECT driver, member, rev, prof, CAST({pct("prof", "rev")} AS DECIMAL(12,2)) AS mp FROM g
)
SELECT driver, member, {dbl("rev")} AS revenue, {dbl("prof")} AS profit, {dbl("mp")} AS margin_pct,
       {ratio("SUM(mp) OVER (PARTITION BY driver)", "COUNT(mp) OVER (PARTITION BY driver)", 4)} AS avg_margin_pct,
       mp * COUNT(mp) OVER (PARTITION BY driver) >= SUM(mp) OVER (PARTITION BY driver) AS above_average
FROM m ORDER BY driver, margin_pct"""),

    "leakage_amounts": q(f"""
, a AS (
  SELECT {dbl("COALESCE(SUM(CASE WHEN discount_percent > 30 THEN discount_amount END), 0)")} AS a,
         {dbl("COALESCE(SUM(CASE WHEN is_returned = 1 THEN profit END), 0)")} AS b,
         {dbl("COALESCE(SUM(CASE WHEN rating <= 2.0 THEN profit END), 0)")} AS c
  FROM fact_sales
)
SELECT 'Deep Discounts (>30%)' AS leakage_type, a AS profit_impact, ABS(a) AS abs_impact FROM a
UNION ALL SELECT 'Returns', b, ABS(b) FROM a
UNION ALL SELECT 'Low-Rated Orders (≤2.0★)', c, ABS(c) FROM a"""),

    "top10_customers_nb": q(f"""
, agg AS (
  SELECT customer_key, SUM(revenue) AS rev, SUM(profit) AS prof, COUNT(DISTINCT order_id) AS orders
  FROM fact_sales GROUP BY customer_key ORDER BY rev DESC, customer_key LIMIT 10
)
SELECT {big("a.customer_key")} AS customer_key, dc.customer_country, {big("a.orders")} AS orders,
       {dbl("a.rev")} AS revenue, {dbl("a.prof")} AS profit,
       {pct("a.prof", "a.rev", 1)} AS margin_pct,
       printf('$%,.2f', ROUND(a.rev, 2)) AS revenue_display,
       printf('$%,.2f', ROUND(a.prof, 2)) AS profit_display
FROM agg a JOIN dim_customer dc ON a.customer_key = dc.customer_key
ORDER BY a.rev DESC, a.customer_key"""),
}
