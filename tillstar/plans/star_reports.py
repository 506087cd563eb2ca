"""Star tables, key assignment and source / sink round trips as reports.

Sink reports write under the shared checkpoint folder and return what they
read back, so every write is verified against the SQL formulation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.metrics import big
from tillstar.operators.quality import derive_date_parts
from tillstar.operators.ranking import OrderSpec, ordered_stats
from tillstar.plans.quality_reports import normalized
from tillstar.plans.warehouse import Warehouse, date_bounds, date_spine, enriched, open_warehouse
from tillstar.schemas import RAW_COLUMNS
from tillstar.session import scratch_path
from tillstar.sources import readers, sinks
from tillstar.sources.tables import drop_tables

AUDIT = ["_created_at", "_updated_at", "_loaded_at", "_ingested_at"]


def _no_audit(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in AUDIT if c in df.columns])


def dim_date(wh):
    return normalized(wh.dim_date)


def dim_customer(wh):
    return normalized(_no_audit(wh.dim_customer))


def dim_product(wh):
    return normalized(_no_audit(wh.dim_product))


def dim_country(wh):
    return normalized(wh.dim_country)


def dim_traffic_source(wh):
    return normalized(wh.dim_traffic_source)


def dim_payment_method(wh):
    return normalized(wh.dim_payment_method)


def surrogate_keys(wh: Warehouse) -> DataFrame:
    """DIM-7 dense 1..n key over every cleaned order."""
    k = ordered_stats(wh.clean.select("order_id"), OrderSpec([("order_id", False)]), row_number="surrogate_key",
                      expected_rows=wh.counts["clean"])
    return k.select(big("order_id").alias("order_id"), "surrogate_key")


def segmented_customers(wh: Warehouse) -> DataFrame:
    """dim_customer with the RFM segment of every customer that has one."""
    from tillstar.plans.customer import rfm_segments_df
    seg = rfm_segments_df(wh).select("customer_id", F.col("customer_segment").alias("_seg"))
    d = wh.dim_customer.join(seg, "customer_id", "left")
    return d.withColumn("customer_segment", F.coalesce("_seg", "customer_segment")).select(*wh.dim_customer.columns)


def stored_tables(wh: Warehouse) -> dict:
    """The star as it is stored: customers carry their segment."""
    return wh.tables() | {"dim_customer": segmented_customers(wh)}


def customer_segment_backfill(wh: Warehouse) -> DataFrame:
    """DIM-8 fill dim_customer.customer_segment from the RFM segments (SCD-1
    overwrite; customers without a segment keep their value)."""
    return segmented_customers(wh).select(big("customer_key").alias("customer_key"),
                                          big("customer_id").alias("customer_id"), "customer_segment")


def fact_sales(wh):
    return normalized(_no_audit(wh.fact))


def sales_enriched(wh):
    return normalized(_no_audit(enriched(wh)))


# --- sources and sinks ------------------------------------------------------

def read_sales_csv_report(wh: Warehouse) -> DataFrame:
    """SRC-1: the raw lines exported as header CSV, read back with the schema."""
    spark = wh.spark
    p = scratch_path(spark, "raw_sales_csv")
    wh.raw_lines().select(*RAW_COLUMNS).write.mode("overwrite").option("header", True).csv(p)
    return normalized(readers.read_sales_csv(spark, p).select(*RAW_COLUMNS))


def read_clean_report(wh: Warehouse) -> DataFrame:
    """SRC-2: the cleaned set as CSV, read back with a typed date."""
    spark = wh.spark
    p = scratch_path(spark, "clean_csv")
    sinks.write_clean(wh.clean, p, fmt="csv")
    return normalized(readers.read_clean(spark, p, "csv"))


def raw_schema_report(wh: Warehouse) -> DataFrame:
    return normalized(readers.raw_schema(wh.raw_lines()).drop("_ingested_at"))


def date_spine_report(wh: Warehouse) -> DataFrame:
    lo, hi = date_bounds(wh.clean)
    return date_spine(wh.spark, lo, hi)


def write_clean_report(wh: Warehouse) -> DataFrame:
    """SNK-1: cleaned set + date parts written as parquet, read back."""
    spark = wh.spark
    p = scratch_path(spark, "clean_parquet")
    sinks.write_clean(derive_date_parts(wh.clean), p)
    return normalized(readers.read_clean(spark, p, "parquet", with_date_parts=True))


def _written_star(wh: Warehouse) -> dict:
    base = scratch_path(wh.spark, "warehouse")
    sinks.write_warehouse(stored_tables(wh), base)
    return readers.load_warehouse(wh.spark, base)


def write_warehouse_report(wh: Warehouse) -> DataFrame:
    """SNK-2: the fact read back from its year-partitioned parquet."""
    t = _written_star(wh)
    return normalized(_no_audit(t["fact_sales"]).drop("order_year"))


def load_warehouse_report(wh: Warehouse) -> DataFrame:
    """SRC-3: all seven tables loaded from the written star, with row counts."""
    return _row_counts(_written_star(wh))


def stored_customers_report(wh: Warehouse) -> DataFrame:
    """The customer dimension read back from a star stored as CSV: customers
    by segment."""
    base = scratch_path(wh.spark, "warehouse_csv")
    sinks.write_warehouse(stored_tables(wh), base, "csv")
    stored = open_warehouse(wh.spark, base, "csv")
    return stored.dim_customer.groupBy("customer_segment").agg(
        big(F.count(F.lit(1))).alias("customers"), F.sum("total_revenue").cast("double").alias("total_revenue"))


def _row_counts(tables: dict) -> DataFrame:
    """table_name, row_count of each table, one aggregate per table."""
    out = None
    for name, df in tables.items():
        part = df.agg(big(F.count(F.lit(1))).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def idempotent_replace_report(wh: Warehouse) -> DataFrame:
    """SNK-3: replacing every star table twice leaves one copy of each, and a
    replacement that fails half-way leaves it as it was."""
    base = scratch_path(wh.spark, "replaced")
    names = {name: f"{name}_{base.rsplit('-', 1)[-1]}" for name in wh.tables()}
    for _ in range(2):
        for name, df in wh.tables().items():
            sinks.idempotent_replace(df, f"{base}/{name}", names[name])
    fact = wh.fact.withColumn("quantity", F.when(F.col("sales_key") % 2 == 1, F.col("quantity")).otherwise(
        F.raise_error(F.lit("the write fails here")).cast("int")))
    try:
        sinks.idempotent_replace(fact, f"{base}/fact_sales", names["fact_sales"])
    except Exception as failure:
        if "the write fails here" not in str(failure):
            raise
    return _counted_once(wh, names)


def insert_select_report(wh: Warehouse) -> DataFrame:
    """SNK-4: catalog tables of the six dimensions and the fact, each loaded by
    INSERT ... SELECT and read back."""
    spark, base = wh.spark, scratch_path(wh.spark, "inserted")
    names = {name: f"{name}_{base.rsplit('-', 1)[-1]}" for name in wh.tables()}
    for name, df in wh.tables().items():
        sinks.insert_select(spark, df, names[name], f"{base}/{name}")
    return _counted_once(wh, names)


def _counted_once(wh: Warehouse, names: dict) -> DataFrame:
    """Row counts of catalog tables, which then leave the catalog."""
    try:
        return _row_counts({name: wh.spark.table(table) for name, table in names.items()}).checkpoint()
    finally:
        drop_tables(wh.spark, list(names.values()))


def register_views_report(wh: Warehouse) -> DataFrame:
    """SNK-5: after registration every star table and view answers plain SQL."""
    return _row_counts({name: wh.spark.sql(f"SELECT * FROM {name}") for name in sinks.register_views(wh.spark, wh)})


VIEWS = {
    "dim_date": dim_date,
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    "dim_country": dim_country,
    "dim_traffic_source": dim_traffic_source,
    "dim_payment_method": dim_payment_method,
    "surrogate_keys": surrogate_keys,
    "customer_segment_backfill": customer_segment_backfill,
    "fact_sales": fact_sales,
    "sales_enriched": sales_enriched,
    "read_sales_csv": read_sales_csv_report,
    "read_clean": read_clean_report,
    "load_warehouse": load_warehouse_report,
    "stored_customers": stored_customers_report,
    "raw_schema": raw_schema_report,
    "date_spine": date_spine_report,
    "write_clean": write_clean_report,
    "write_warehouse": write_warehouse_report,
    "idempotent_replace": idempotent_replace_report,
    "insert_select": insert_select_report,
    "register_views": register_views_report,
}


def stream_ingest_report(wh: Warehouse) -> DataFrame:
    """Streaming raw load: the raw lines land as CSV files, a file stream
    ingests them (available-now trigger) into the raw table, read back."""
    from tillstar.streaming.ingest import start_raw_ingest
    spark = wh.spark
    src = scratch_path(spark, "landing")
    wh.raw_lines().select(*RAW_COLUMNS).write.option("header", True).csv(src)
    tgt, ck = scratch_path(spark, "raw_stream"), scratch_path(spark, "raw_stream_ckpt")
    start_raw_ingest(spark, src, tgt, ck).awaitTermination()
    return normalized(spark.read.parquet(tgt).drop("_ingested_at", "batch_id"))


VIEWS["stream_ingest"] = stream_ingest_report
