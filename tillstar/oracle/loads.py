"""Oracle SQL of the second load: keys by the load that first saw a member."""

from tillstar.oracle import big, q
from tillstar.oracle.star import _FACT_COLS

_MONTH = "year(order_date) * 100 + month(order_date)"
# every order with its month, whether the first load saw it and with which country
_SEEN = f"""
, ends AS (SELECT min({_MONTH}) AS lo, max({_MONTH}) AS hi FROM clean),
seen AS (
  SELECT clean.*, {_MONTH} AS order_month,
         CASE WHEN {_MONTH} = hi OR ({_MONTH} = lo AND order_id % 3 = 0) THEN 2 ELSE 1 END AS load,
         CASE WHEN {_MONTH} = lo AND order_id % 3 = 1 THEN 'UK' ELSE customer_country END AS country_then
  FROM clean CROSS JOIN ends
),
k_order AS (SELECT order_id, row_number() OVER (ORDER BY load, order_id) AS k FROM seen),
k_customer AS (SELECT customer_id, row_number() OVER (ORDER BY min(load), customer_id) AS k FROM seen GROUP BY 1),
k_product AS (SELECT product_id, product_category, row_number() OVER (ORDER BY min(load), product_id, product_category) AS k
              FROM seen GROUP BY 1, 2),
k_country AS (
  SELECT name, row_number() OVER (ORDER BY min(load), name) AS k
  FROM (SELECT country_then AS name, load FROM seen WHERE load = 1 UNION ALL SELECT customer_country, 2 FROM seen) GROUP BY 1),
k_source AS (SELECT traffic_source AS name, row_number() OVER (ORDER BY min(load), traffic_source) AS k FROM seen GROUP BY 1),
k_payment AS (SELECT payment_method AS name, row_number() OVER (ORDER BY min(load), payment_method) AS k FROM seen GROUP BY 1),
keyed_fact AS (
  SELECT f.* REPLACE (ko.k AS sales_key, kc.k AS customer_key, kp.k AS product_key, kl.k AS country_key,
                      ks.k AS traffic_source_key, km.k AS payment_method_key)
  FROM fact_sales f JOIN seen USING (order_id) JOIN k_order ko USING (order_id) JOIN k_customer kc USING (customer_id)
  JOIN k_product kp USING (product_id, product_category) JOIN k_country kl ON kl.name = customer_country
  JOIN k_source ks ON ks.name = traffic_source JOIN k_payment km ON km.name = payment_method
)"""

_CUSTOMER_COLS = """customer_country, first_order_date, last_order_date, CAST(total_orders AS BIGINT) AS total_orders,
       CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_profit AS DOUBLE) AS total_profit,
       CAST(avg_order_value AS DOUBLE) AS avg_order_value, is_repeat_customer, CAST(avg_rating AS DOUBLE) AS avg_rating,
       CAST(customer_lifespan_days AS BIGINT) AS customer_lifespan_days"""

SQL = {
    "second_load_fact": q(_SEEN + f" SELECT {_FACT_COLS} FROM keyed_fact"),
    "second_load_customers": q(_SEEN + f"""
SELECT {big('k')} AS customer_key, {big('customer_id')} AS customer_id, {_CUSTOMER_COLS},
       CAST(NULL AS VARCHAR) AS customer_segment
FROM dim_customer JOIN k_customer USING (customer_id)"""),
    "second_load_products": q(_SEEN + f"""
SELECT {big('k')} AS product_key, {big('product_id')} AS product_id, product_category,
       CAST(avg_list_price AS DOUBLE) AS avg_list_price, CAST(avg_discount_pct AS DOUBLE) AS avg_discount_pct,
       {big('total_units_sold')} AS total_units_sold, CAST(total_revenue AS DOUBLE) AS total_revenue,
       CAST(total_profit AS DOUBLE) AS total_profit, CAST(return_rate AS DOUBLE) AS return_rate,
       CAST(avg_rating AS DOUBLE) AS avg_rating, {big('order_count')} AS order_count
FROM dim_product JOIN k_product USING (product_id, product_category)"""),
    "second_load_partitions": q(_SEEN + f"""
SELECT {big('order_month')} AS order_month, {big('count(*)')} AS row_count, bool_or(order_month IN (lo, hi)) AS rewritten
FROM seen CROSS JOIN ends GROUP BY order_month"""),
    "key_registry": q(_SEEN + "\nUNION ALL ".join(
        f" SELECT '{t}' AS dimension, {member} AS member, {big('k')} AS member_key FROM {table}"
        for t, member, table in (
            ("dim_customer", "CAST(customer_id AS VARCHAR)", "k_customer"),
            ("dim_product", "CAST(product_id AS VARCHAR) || '/' || product_category", "k_product"),
            ("dim_country", "name", "k_country"), ("dim_traffic_source", "name", "k_source"),
            ("dim_payment_method", "name", "k_payment")))),
    "merged_customer_states": q(f"SELECT {big('customer_id')} AS customer_id, {_CUSTOMER_COLS} FROM dim_customer"),
}
