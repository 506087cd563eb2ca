"""Adapter from the driver's TPC-H-like tables to the raw sales export.

The test tables (lineitem, orders, customer, nation, part) are mapped to the
17-column raw sales layout at *line* grain.  The mapping is a fixed rule set
so that results are reproducible in any engine; all money is exact DECIMAL
(no division while staging).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.mappings import lookup
from tillstar.schemas import INGEST_SEQ, RAW_COLUMNS

# --- fixed values: adapter mapping of test-data codes to business labels
NATION_COUNTRY = {  # n_nationkey % 9
    0: "USA", 1: "Canada", 2: "UK", 3: "UAE", 4: "India",
    5: "Germany", 6: "France", 7: "Australia", 8: "Brazil",
}
PRIORITY_SOURCE = {  # first character of o_orderpriority
    "1": "Paid Ads", "2": "Email", "3": "Social Media", "4": "Organic", "5": "Direct",
}
SEGMENT_PAYMENT = {  # c_mktsegment; anything else pays cash on delivery
    "AUTOMOBILE": "Credit Card", "BUILDING": "Debit Card",
    "FURNITURE": "PayPal", "HOUSEHOLD": "Apple Pay",
}
PAYMENT_FALLBACK = "Cash on Delivery"

SOURCE_TABLES = ("lineitem", "orders", "customer", "nation", "part")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec(v: str, p: int, s: int) -> Column:
    return F.lit(v).cast(f"decimal({p},{s})")


def stage_raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-grain raw sales (order_id repeats) plus the ingestion sequence."""
    return sales_rows(sales_lines(spark, sf_dir))


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with what their order, customer and part give, before the mapping.

    Only the columns the mapping needs are selected, so each parquet scan
    reads a pruned schema.  The four small tables join by broadcast hash
    join when their size allows (AQE / size statistics decide)."""
    # what the mapping makes of a line's own columns is made before it moves
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate",
        F.round(F.col("l_discount") * 500, 0).cast("int").alias("_disc"),
        F.round(F.col("l_tax") * 1000, 0).cast("int").alias("_tax"),
        (F.col("l_quantity").cast("int") % 10 + 1).alias("_qty"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("_returned"))
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey")
    pa = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    # An unsplittable input (one file, one row group) scans in one task; the
    # joins, projections and the dedup pre-sort would then run serially.
    # Spread it round-robin only in that case -- many-file inputs keep their
    # scan parallelism and skip this shuffle.
    target = spark.sparkContext.defaultParallelism
    if li.rdd.getNumPartitions() < target:
        li = li.repartition(target)

    # customer and nation attributes are attached at ORDER grain (a quarter
    # of the line count) before the orders meet their lines, so no
    # line-sized shuffle is spent on the customer join
    oc = (od.join(cu, od.o_custkey == cu.c_custkey)
            .join(na, cu.c_nationkey == na.n_nationkey)
            .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "c_mktsegment", "n_nationkey"))
    # orders last: the rows stay spread by order, as the keep-first per order
    # needs them, and the finished rows (the widest) are not shuffled again
    j = (li.join(pa, li.l_partkey == pa.p_partkey)
           .join(oc, li.l_orderkey == oc.o_orderkey))

    return j.select(
        F.col("l_orderkey").alias("order_id"), "l_suppkey", "l_partkey", "_disc", "_tax", "_qty", "_returned",
        "p_type", "p_retailprice", "o_custkey", "o_orderdate", "o_orderpriority", "c_mktsegment", "n_nationkey",
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate").alias(INGEST_SEQ))


def sales_rows(lines: DataFrame) -> DataFrame:
    """The raw sales layout of ``sales_lines``, row for row."""
    price = (F.col("p_retailprice").cast("decimal(12,2)") * _dec("0.2", 2, 1)).cast("decimal(10,2)")
    rating = (F.when(F.col("l_suppkey") % 11 == 0, F.lit(None))
              .otherwise(F.lit(1) + _dec("0.5", 1, 1) * (F.col("l_suppkey") % 9).cast("decimal(2,0)"))
              ).cast("decimal(3,1)")

    staged = lines.select(
        "order_id",
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_type").alias("product_category"),
        price.alias("product_price"),
        "_disc",
        F.col("_qty").alias("quantity"),
        lookup(F.col("n_nationkey") % 9, NATION_COUNTRY, None).alias("customer_country"),
        lookup(F.substring("o_orderpriority", 1, 1), PRIORITY_SOURCE, None).alias("traffic_source"),
        lookup(F.col("c_mktsegment"), SEGMENT_PAYMENT, PAYMENT_FALLBACK).alias("payment_method"),
        "_tax",
        rating.alias("rating"),
        F.col("_returned").alias("is_returned"),
        INGEST_SEQ,
    )
    # Exact money with every intermediate at most 18 digits, so Spark keeps
    # the decimals in longs: small integer factors as decimal(3,0)/(4,0) and
    # the 0.01 factor as decimal(2,2).
    pct_left = (F.lit(100) - F.col("_disc")).cast("decimal(3,0)")
    dprice = F.round(F.col("product_price") * pct_left * _dec("0.01", 2, 2), 2).cast("decimal(10,2)")
    ship = F.round(F.col("product_price") * F.col("_tax").cast("decimal(4,0)") * _dec("0.01", 2, 2), 2
                   ).cast("decimal(10,2)")
    staged = (staged.withColumn("discounted_price", dprice)
                    .withColumn("shipping_cost", ship)
                    .withColumn("discount_percent", F.col("_disc").cast("decimal(5,2)")))
    qty_dec = F.col("quantity").cast("decimal(3,0)")
    staged = (staged.withColumn("revenue", (F.col("discounted_price") * qty_dec).cast("decimal(12,2)"))
                    .withColumn("profit", (F.col("discounted_price") * qty_dec - F.col("shipping_cost"))
                                .cast("decimal(12,2)")))
    return staged.select(*RAW_COLUMNS, INGEST_SEQ)
