"""Explicit schemas: tables are never read with schema inference."""

from pyspark.sql import types as T

# Raw sales: one row per order line as exported (17 business columns).
RAW_SALES = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("order_date", T.DateType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_category", T.StringType(), False),
    T.StructField("product_price", T.DecimalType(10, 2), False),
    T.StructField("discount_percent", T.DecimalType(5, 2), False),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("customer_country", T.StringType(), False),
    T.StructField("traffic_source", T.StringType(), False),
    T.StructField("payment_method", T.StringType(), False),
    T.StructField("shipping_cost", T.DecimalType(10, 2), False),
    T.StructField("rating", T.DecimalType(3, 1), True),
    T.StructField("is_returned", T.IntegerType(), False),
    T.StructField("discounted_price", T.DecimalType(10, 2), False),
    T.StructField("revenue", T.DecimalType(12, 2), False),
    T.StructField("profit", T.DecimalType(12, 2), False),
])

RAW_COLUMNS = [f.name for f in RAW_SALES.fields]

# Audit columns added at ingestion (SRC-4).
AUDIT_COLUMNS = ["_ingested_at", "_source"]
DEFAULT_SOURCE = "sales_export"

# Column defaults of the raw table DDL.
RAW_DEFAULTS = {"discount_percent": 0, "quantity": 1, "shipping_cost": 0, "is_returned": 0}

# Same columns as text: the loose form a CSV export arrives in, before the
# type-coercion step of the cleaning job.
RAW_SALES_TEXT = T.StructType([T.StructField(f.name, T.StringType(), True) for f in RAW_SALES.fields])

INT_COLUMNS = ["order_id", "customer_id", "product_id", "quantity", "is_returned"]
MONEY_COLUMNS = ["product_price", "discount_percent", "shipping_cost", "rating",
                 "discounted_price", "revenue", "profit"]
CATEGORICAL_COLUMNS = ["product_category", "customer_country", "traffic_source", "payment_method"]
OUTLIER_COLUMNS = ["revenue", "profit", "product_price", "shipping_cost", "quantity"]

# Sequence column carried from ingestion; defines "first occurrence" for the
# keep-first de-duplication (file order in the original export).
INGEST_SEQ = "_ingest_seq"

# The stored star, as it is written and read back.
STAR_SCHEMAS = {
    "fact_sales": "sales_key bigint, order_id bigint, date_key int, customer_key bigint, product_key bigint, "
                  "country_key int, traffic_source_key int, payment_method_key int, quantity int, "
                  "product_price decimal(10,2), discounted_price decimal(10,2), discount_percent decimal(5,2), "
                  "discount_amount decimal(12,2), shipping_cost decimal(10,2), revenue decimal(12,2), "
                  "profit decimal(12,2), gross_revenue decimal(12,2), profit_margin_pct decimal(7,4), "
                  "rating decimal(3,1), is_returned int, _loaded_at timestamp, order_year int",
    "dim_date": "date_key int, full_date date, year int, quarter int, quarter_label string, month int, "
                "month_name string, month_label string, week_of_year int, day_of_month int, day_of_week int, "
                "day_name string, is_weekend boolean, is_weekday boolean, fiscal_year int, fiscal_quarter int",
    "dim_customer": "customer_key bigint, customer_id bigint, customer_country string, first_order_date date, "
                    "last_order_date date, total_orders bigint, total_revenue decimal(22,2), "
                    "total_profit decimal(22,2), avg_order_value decimal(10,2), is_repeat_customer boolean, "
                    "customer_segment string, avg_rating decimal(3,2), customer_lifespan_days int, "
                    "_created_at timestamp, _updated_at timestamp",
    "dim_product": "product_key bigint, product_id bigint, product_category string, avg_list_price decimal(10,2), "
                   "avg_discount_pct decimal(5,2), total_units_sold bigint, total_revenue decimal(22,2), "
                   "total_profit decimal(22,2), return_rate decimal(5,4), avg_rating decimal(3,2), "
                   "order_count bigint, _created_at timestamp",
    "dim_country": "country_key int, country_name string, region string, currency_code string",
    "dim_traffic_source": "traffic_source_key int, traffic_source string, channel_type string, is_paid boolean",
    "dim_payment_method": "payment_method_key int, payment_method string, payment_type string, "
                          "is_digital_wallet boolean",
}
