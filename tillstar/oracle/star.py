"""Oracle SQL for the star tables, key assignment and source / sink reports."""

from tillstar.oracle import big, q
from tillstar.oracle.customer import SCORED, SQL as CUSTOMER
from tillstar.oracle.kpi import SQL as KPI
from tillstar.oracle.marketing import SQL as MARKETING
from tillstar.oracle.quality import NORM17

_DATE = """SELECT CAST(date_key AS BIGINT) AS date_key, full_date, CAST(year AS BIGINT) AS year,
       CAST(quarter AS BIGINT) AS quarter, quarter_label, CAST(month AS BIGINT) AS month, month_name, month_label,
       CAST(week_of_year AS BIGINT) AS week_of_year, CAST(day_of_month AS BIGINT) AS day_of_month,
       CAST(day_of_week AS BIGINT) AS day_of_week, day_name, is_weekend, is_weekday,
       CAST(fiscal_year AS BIGINT) AS fiscal_year, CAST(fiscal_quarter AS BIGINT) AS fiscal_quarter
FROM dim_date"""

_CUST = """SELECT CAST(customer_key AS BIGINT) AS customer_key, CAST(customer_id AS BIGINT) AS customer_id,
       customer_country, first_order_date, last_order_date, CAST(total_orders AS BIGINT) AS total_orders,
       CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_profit AS DOUBLE) AS total_profit,
       CAST(avg_order_value AS DOUBLE) AS avg_order_value, is_repeat_customer,
       CAST(NULL AS VARCHAR) AS customer_segment, CAST(avg_rating AS DOUBLE) AS avg_rating,
       CAST(customer_lifespan_days AS BIGINT) AS customer_lifespan_days
FROM dim_customer"""

_PROD = """SELECT CAST(product_key AS BIGINT) AS product_key, CAST(product_id AS BIGINT) AS product_id, product_category,
       CAST(avg_list_price AS DOUBLE) AS avg_list_price, CAST(avg_discount_pct AS DOUBLE) AS avg_discount_pct,
       CAST(total_units_sold AS BIGINT) AS total_units_sold, CAST(total_revenue AS DOUBLE) AS total_revenue,
       CAST(total_profit AS DOUBLE) AS total_profit, CAST(return_rate AS DOUBLE) AS return_rate,
       CAST(avg_rating AS DOUBLE) AS avg_rating, CAST(order_count AS BIGINT) AS order_count
FROM dim_product"""

_FACT_COLS = """CAST(sales_key AS BIGINT) AS sales_key, CAST(order_id AS BIGINT) AS order_id,
       CAST(date_key AS BIGINT) AS date_key, CAST(customer_key AS BIGINT) AS customer_key,
       CAST(product_key AS BIGINT) AS product_key, CAST(country_key AS BIGINT) AS country_key,
       CAST(traffic_source_key AS BIGINT) AS traffic_source_key, CAST(payment_method_key AS BIGINT) AS payment_method_key,
       CAST(quantity AS BIGINT) AS quantity, CAST(product_price AS DOUBLE) AS product_price,
       CAST(discounted_price AS DOUBLE) AS discounted_price, CAST(discount_percent AS DOUBLE) AS discount_percent,
       CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(shipping_cost AS DOUBLE) AS shipping_cost,
       CAST(revenue AS DOUBLE) AS revenue, CAST(profit AS DOUBLE) AS profit,
       CAST(gross_revenue AS DOUBLE) AS gross_revenue, CAST(profit_margin_pct AS DOUBLE) AS profit_margin_pct,
       CAST(rating AS DOUBLE) AS rating, CAST(is_returned AS BIGINT) AS is_returned"""

_TABLES = ["fact_sales", "dim_date", "dim_customer", "dim_product", "dim_country", "dim_traffic_source",
           "dim_payment_method"]

SQL = {
    "dim_date": q(_DATE),
    "dim_customer": q(_CUST),
    "dim_product": q(_PROD),
    "dim_country": q("SELECT CAST(country_key AS BIGINT) AS country_key, country_name, region, currency_code "
                     "FROM dim_country"),
    "dim_traffic_source": q("SELECT CAST(traffic_source_key AS BIGINT) AS traffic_source_key, traffic_source, "
                            "channel_type, is_paid FROM dim_traffic_source"),
    "dim_payment_method": q("SELECT CAST(payment_method_key AS BIGINT) AS payment_method_key, payment_method, "
                            "payment_type, is_digital_wallet FROM dim_payment_method"),
    "surrogate_keys": q(f"SELECT {big('order_id')} AS order_id, "
                        f"{big('ROW_NUMBER() OVER (ORDER BY order_id)')} AS surrogate_key FROM clean"),
    "customer_segment_backfill": q(SCORED + f"""
SELECT {big("customer_key")} AS customer_key, {big("customer_id")} AS customer_id, customer_segment FROM segmented"""),
    "fact_sales": q(f"SELECT {_FACT_COLS} FROM fact_sales"),
    "sales_enriched": q(f"""
SELECT {_FACT_COLS.replace('CAST(', 'CAST(fs.').replace('CAST(fs.fs.', 'CAST(fs.')},
       CAST(dd.year AS BIGINT) AS year, CAST(dd.month AS BIGINT) AS month, dd.month_label, dd.quarter_label,
       dd.full_date, dp.product_category, dco.country_name, dco.region, dts.traffic_source, dts.channel_type,
       dts.is_paid, dpm.payment_method
FROM fact_sales fs
JOIN dim_date dd ON fs.date_key = dd.date_key
JOIN dim_product dp ON fs.product_key = dp.product_key
JOIN dim_country dco ON fs.country_key = dco.country_key
JOIN dim_traffic_source dts ON fs.traffic_source_key = dts.traffic_source_key
JOIN dim_payment_method dpm ON fs.payment_method_key = dpm.payment_method_key"""),
    "read_sales_csv": q(f"SELECT {NORM17} FROM raw_sales"),
    "read_clean": q(f"SELECT {NORM17} FROM clean"),
    "load_warehouse": q("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, {big('COUNT(*)')} AS row_count FROM {t}" for t in _TABLES)),
    "raw_schema": q(f"SELECT {NORM17}, 'sales_export' AS _source FROM raw_sales"),
    "date_spine": q("SELECT full_date FROM spine"),
    "write_clean": q(f"""SELECT {NORM17}, {big('year(order_date)')} AS order_year,
       {big('month(order_date)')} AS order_month, {big('quarter(order_date)')} AS order_quarter,
       strftime(order_date, '%A') AS order_dow FROM clean"""),
    "write_warehouse": q(f"SELECT {_FACT_COLS} FROM fact_sales"),
}

_COUNTS = "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, {big('count(*)')} AS row_count FROM {t}" for t in _TABLES)
_VIEW_COUNTS = "\nUNION ALL ".join(f"SELECT '{name}' AS table_name, {big('count(*)')} AS row_count FROM ({sql})"
                                   for name, sql in {**KPI, **CUSTOMER, **MARKETING}.items())
SQL["stored_customers"] = q(SCORED + f"""
SELECT customer_segment, {big("count(*)")} AS customers, CAST(sum(monetary) AS DOUBLE) AS total_revenue
FROM segmented GROUP BY customer_segment""")
SQL["idempotent_replace"] = q(_COUNTS)
SQL["insert_select"] = q(_COUNTS)
SQL["register_views"] = q(_COUNTS + "\nUNION ALL " + _VIEW_COUNTS)
SQL["stream_ingest"] = q(f"SELECT {NORM17}, 'sales_export' AS _source FROM raw_sales")
