"""Independent SQL formulations of every report, for DuckDB.

Each string starts from the driver's raw tables (views ``lineitem``,
``orders`` ...), rebuilds the raw sales, the keep-first de-duplication, the
dimensions and the fact in SQL, then runs the report.  Rounding follows the
same contract as :mod:`tillstar.functions.metrics`.
"""

from __future__ import annotations


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def snap(x: str, scale: int = 2) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {scale}) AS DOUBLE)"


def ratio(num: str, den: str, scale: int = 2, factor: str | None = None) -> str:
    q = f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)"
    if factor:
        q = f"{q} * {factor}"
    return snap(q, scale)


def pct(num: str, den: str, scale: int = 2) -> str:
    return ratio(num, den, scale, "100.0")


def money(x: str, scale: int = 2) -> str:
    return f"CAST(ROUND({x}, {scale}) AS DOUBLE)"


def avg(x: str, scale: int = 2) -> str:
    return ratio(f"SUM({x})", f"COUNT({x})", scale)


# --- fixed values: the adapter's label mapping, repeated in SQL form
_ADAPTER = """
stg AS (
  SELECT l.l_orderkey AS order_id,
         CAST(o.o_orderdate AS DATE) AS order_date,
         o.o_custkey AS customer_id,
         l.l_partkey AS product_id,
         p.p_type AS product_category,
         CAST(CAST(p.p_retailprice AS DECIMAL(12,2)) * CAST(0.2 AS DECIMAL(2,1)) AS DECIMAL(10,2)) AS product_price,
         CAST(ROUND(l.l_discount * 500, 0) AS INTEGER) AS disc,
         CAST(l.l_quantity AS INTEGER) % 10 + 1 AS quantity,
         CASE n.n_nationkey % 9 WHEN 0 THEN 'USA' WHEN 1 THEN 'Canada' WHEN 2 THEN 'UK'
              WHEN 3 THEN 'UAE' WHEN 4 THEN 'India' WHEN 5 THEN 'Germany' WHEN 6 THEN 'France'
              WHEN 7 THEN 'Australia' WHEN 8 THEN 'Brazil' END AS customer_country,
         CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 'Paid Ads' WHEN '2' THEN 'Email'
              WHEN '3' THEN 'Social Media' WHEN '4' THEN 'Organic' WHEN '5' THEN 'Direct' END AS traffic_source,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Credit Card' WHEN 'BUILDING' THEN 'Debit Card'
              WHEN 'FURNITURE' THEN 'PayPal' WHEN 'HOUSEHOLD' THEN 'Apple Pay'
              ELSE 'Cash on Delivery' END AS payment_method,
         CAST(ROUND(l.l_tax * 1000, 0) AS INTEGER) AS tax,
         CASE WHEN l.l_suppkey % 11 = 0 THEN NULL
              ELSE CAST(1 + CAST(0.5 AS DECIMAL(2,1)) * (l.l_suppkey % 9) AS DECIMAL(3,1)) END AS rating,
         CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS is_returned,
         l.l_linenumber AS s1, l.l_partkey AS s2, l.l_suppkey AS s3, l.l_extendedprice AS s4, l.l_shipdate AS s5
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
raw_lines AS (
  SELECT order_id, order_date, customer_id, product_id, product_category, product_price,
         CAST(disc AS DECIMAL(5,2)) AS discount_percent, quantity, customer_country, traffic_source,
         payment_method,
         CAST(ROUND(product_price * tax * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(10,2)) AS shipping_cost,
         rating, is_returned,
         CAST(ROUND(product_price * (100 - disc) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(10,2)) AS discounted_price,
         s1, s2, s3, s4, s5
  FROM stg
),
raw_sales AS (
  SELECT order_id, order_date, customer_id, product_id, product_category, product_price, discount_percent,
         quantity, customer_country, traffic_source, payment_method, shipping_cost, rating, is_returned,
         discounted_price,
         CAST(discounted_price * quantity AS DECIMAL(12,2)) AS revenue,
         CAST(discounted_price * quantity - shipping_cost AS DECIMAL(12,2)) AS profit,
         s1, s2, s3, s4, s5
  FROM raw_lines
),
clean AS (
  SELECT order_id, order_date, customer_id, product_id, product_category, product_price, discount_percent,
         quantity, customer_country, traffic_source, payment_method, shipping_cost, rating, is_returned,
         discounted_price, revenue, profit
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY s1, s2, s3, s4, s5) AS rn FROM raw_sales)
  WHERE rn = 1
)"""

_DIMS = """
bounds AS (
  SELECT make_date(CAST(year(MIN(order_date)) AS BIGINT), 1, 1) AS lo,
         make_date(CAST(year(MAX(order_date)) AS BIGINT), 12, 31) AS hi
  FROM clean
),
spine AS (
  SELECT CAST(r.d AS DATE) AS full_date
  FROM bounds b, range(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY) r(d)
),
dim_date AS (
  SELECT CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INTEGER) AS date_key,
         full_date,
         year(full_date) AS year,
         quarter(full_date) AS quarter,
         'Q' || CAST(quarter(full_date) AS VARCHAR) || ' ' || CAST(year(full_date) AS VARCHAR) AS quarter_label,
         month(full_date) AS month,
         strftime(full_date, '%B') AS month_name,
         strftime(full_date, '%b %Y') AS month_label,
         weekofyear(full_date) AS week_of_year,
         day(full_date) AS day_of_month,
         dayofweek(full_date) + 1 AS day_of_week,
         strftime(full_date, '%A') AS day_name,
         dayofweek(full_date) IN (0, 6) AS is_weekend,
         dayofweek(full_date) NOT IN (0, 6) AS is_weekday,
         CASE WHEN month(full_date) >= 4 THEN year(full_date) ELSE year(full_date) - 1 END AS fiscal_year,
         CASE WHEN month(full_date) IN (4,5,6) THEN 1 WHEN month(full_date) IN (7,8,9) THEN 2
              WHEN month(full_date) IN (10,11,12) THEN 3 ELSE 4 END AS fiscal_quarter
  FROM spine
),
latest AS (
  SELECT DISTINCT ON (customer_id) customer_id, customer_country
  FROM clean ORDER BY customer_id, order_date DESC, order_id DESC
),
lifetime AS (
  SELECT customer_id, min(order_date) AS since, max(order_date) AS until, count(*) AS n,
         sum(revenue) AS turnover, sum(profit) AS gain, sum(rating) AS stars, count(rating) AS rated
  FROM clean GROUP BY customer_id
),
dim_customer AS (
  SELECT dense_rank() OVER (ORDER BY customer_id) AS customer_key,
         customer_id, customer_country, since AS first_order_date, until AS last_order_date,
         n AS total_orders, turnover AS total_revenue, gain AS total_profit,
         CAST(""" + ratio("turnover", "n") + """ AS DECIMAL(10,2)) AS avg_order_value,
         n >= 2 AS is_repeat_customer,
         CAST(""" + ratio("stars", "NULLIF(rated, 0)") + """ AS DECIMAL(3,2)) AS avg_rating,
         until - since AS customer_lifespan_days
  FROM lifetime JOIN latest USING (customer_id)
),
dim_product AS (
  SELECT row_number() OVER (ORDER BY product_id, product_category) AS product_key,
         product_id, product_category,
         CAST(""" + ratio("SUM(product_price)", "COUNT(*)") + """ AS DECIMAL(10,2)) AS avg_list_price,
         CAST(""" + ratio("SUM(discount_percent)", "COUNT(*)") + """ AS DECIMAL(5,2)) AS avg_discount_pct,
         SUM(quantity) AS total_units_sold,
         SUM(revenue) AS total_revenue,
         SUM(profit) AS total_profit,
         CAST(""" + ratio("SUM(is_returned)", "COUNT(*)", 4) + """ AS DECIMAL(5,4)) AS return_rate,
         CAST(""" + avg("rating") + """ AS DECIMAL(3,2)) AS avg_rating,
         COUNT(DISTINCT order_id) AS order_count
  FROM clean GROUP BY product_id, product_category
),
dim_country AS (
  SELECT row_number() OVER (ORDER BY country_name) AS country_key, country_name,
         CASE country_name WHEN 'USA' THEN 'North America' WHEN 'Canada' THEN 'North America'
              WHEN 'UK' THEN 'Europe' WHEN 'UAE' THEN 'Middle East' WHEN 'India' THEN 'South Asia'
              WHEN 'Germany' THEN 'Europe' WHEN 'France' THEN 'Europe' WHEN 'Australia' THEN 'Oceania'
              ELSE 'Other' END AS region,
         CASE country_name WHEN 'USA' THEN 'USD' WHEN 'Canada' THEN 'CAD' WHEN 'UK' THEN 'GBP'
              WHEN 'UAE' THEN 'AED' WHEN 'India' THEN 'INR' WHEN 'Germany' THEN 'EUR'
              WHEN 'France' THEN 'EUR' WHEN 'Australia' THEN 'AUD' ELSE 'USD' END AS currency_code
  FROM (SELECT DISTINCT customer_country AS country_name FROM clean)
),
dim_traffic_source AS (
  SELECT row_number() OVER (ORDER BY traffic_source) AS traffic_source_key, traffic_source,
         CASE traffic_source WHEN 'Paid Ads' THEN 'Paid' WHEN 'Email' THEN 'Owned'
              WHEN 'Social Media' THEN 'Paid/Organic' WHEN 'Organic' THEN 'Organic'
              WHEN 'Direct' THEN 'Direct' ELSE 'Other' END AS channel_type,
         traffic_source IN ('Paid Ads', 'Social Media') AS is_paid
  FROM (SELECT DISTINCT traffic_source FROM clean)
),
dim_payment_method AS (
  SELECT row_number() OVER (ORDER BY payment_method) AS payment_method_key, payment_method,
         CASE payment_method WHEN 'Credit Card' THEN 'Card' WHEN 'Debit Card' THEN 'Card'
              WHEN 'PayPal' THEN 'Digital Wallet' WHEN 'Apple Pay' THEN 'Digital Wallet'
              WHEN 'Cash on Delivery' THEN 'COD' ELSE 'Other' END AS payment_type,
         payment_method IN ('PayPal', 'Apple Pay') AS is_digital_wallet
  FROM (SELECT DISTINCT payment_method FROM clean)
),
sold AS (
  SELECT clean.*, customer_key, product_key, country_key, traffic_source_key, payment_method_key,
         date_key, year, quarter, month, month_label, quarter_label,
         region, channel_type, is_paid, payment_type, is_digital_wallet,
         CAST(quantity * product_price AS DECIMAL(12,2)) AS list_amount,
         CAST(quantity * (product_price - discounted_price) AS DECIMAL(12,2)) AS reduction
  FROM clean
  JOIN (SELECT customer_key, customer_id FROM dim_customer) USING (customer_id)
  JOIN (SELECT product_key, product_id, product_category FROM dim_product) USING (product_id, product_category)
  JOIN dim_country ON country_name = customer_country
  JOIN dim_traffic_source USING (traffic_source)
  JOIN dim_payment_method USING (payment_method)
  JOIN dim_date ON full_date = order_date
),
fact_sales AS (
  SELECT dense_rank() OVER (ORDER BY order_id) AS sales_key, order_id, date_key, customer_key, product_key,
         country_key, traffic_source_key, payment_method_key, quantity, product_price, discounted_price,
         discount_percent, reduction AS discount_amount, shipping_cost, revenue, profit,
         list_amount AS gross_revenue,
         CAST(""" + ratio("profit", "revenue", 4) + """ AS DECIMAL(7,4)) AS profit_margin_pct,
         rating, is_returned
  FROM sold
)"""

PREFIX = "WITH" + _ADAPTER + "," + _DIMS + "\n"


def q(body: str) -> str:
    """Full oracle statement: the shared CTE prefix + a report body.

    A body that needs its own CTEs starts with ``, name AS (...)``."""
    body = body.strip()
    if body.startswith(","):
        return PREFIX + body + "\n"
    return PREFIX + body + "\n"


# Measures over groups of cleaned orders (one row is one order).
MEASURES = {
    "orders": big("count(*)"),
    "customers": big("count(DISTINCT customer_id)"),
    "units": big("sum(quantity)"),
    "revenue": money("sum(revenue)"),
    "list_revenue": money("sum(list_amount)"),
    "profit": money("sum(profit)"),
    "reductions": money("sum(reduction)"),
    "shipping": money("sum(shipping_cost)"),
    "order_value": ratio("sum(revenue)", "count(*)"),
    "margin": pct("sum(profit)", "sum(revenue)"),
    "reduction_rate": pct("sum(reduction)", "sum(list_amount)"),
    "returned": big("sum(is_returned)"),
    "return_rate": pct("sum(is_returned)", "count(*)"),
    "returned_revenue": money("sum(revenue * is_returned)"),
    "returned_profit": money("sum(profit * is_returned)"),
    "stars": avg("rating"),
    "stars_returned": ratio("sum(rating) FILTER (is_returned = 1)", "count(rating) FILTER (is_returned = 1)"),
    "stars_kept": ratio("sum(rating) FILTER (is_returned = 0)", "count(rating) FILTER (is_returned = 0)"),
    "discount": avg("discount_percent"),
    "share": pct("sum(revenue)", "sum(sum(revenue)) OVER ()"),
    "rank": big("rank() OVER (ORDER BY sum(revenue) DESC)"),
    "from": "min(order_date)",
    "to": "max(order_date)",
}
WHOLE = {"year", "quarter", "month", "product_key", "product_id", "customer_id", "customer_key"}


def measures(out: dict) -> str:
    """Select list of ``out``: column -> name of a measure, or SQL of its own."""
    return ", ".join(f"{MEASURES.get(m, m)} AS {column}" for column, m in out.items())


def grouped(keys: str, rename: dict | None = None, tail: str = "", **out: str) -> str:
    """Statement: measures of the sold orders by ``keys`` (names with blanks
    between); ``rename`` names keys anew."""
    names = keys.split()
    listed = [f"{big(k) if k in WHOLE else k} AS {(rename or {}).get(k, k)}" for k in names]
    by = f" GROUP BY {', '.join(names)}" if names else ""
    return q(f"SELECT {', '.join([*listed, measures(out)])} FROM sold{by} {tail}")
