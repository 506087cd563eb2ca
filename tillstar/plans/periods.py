"""Monthly sales states that roll up to quarters, years and the total.

One pass over the fact makes a row per month and block of 32,768 customer
keys: sums, counts and an exact bitmap of the customers with orders (4 KB).
Sums add up over months; bitmaps are united, so the distinct customers of any
span of months are counted without the fact.  Every report on time spans reads
this table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions import calendar as cal
from tillstar.functions.metrics import big, ratio
from tillstar.plans.warehouse import Warehouse

SUMS = ["revenue", "gross_revenue", "profit", "discount_amount", "shipping_cost", "is_returned", "rating"]
MONTH, BLOCK, BITS = "month_key", "customer_block", "customers"


def month_states(fact: DataFrame) -> DataFrame:
    """month_key (yyyymm), customer_block, sums, counts, date range, bitmap."""
    month = F.floor(F.col("date_key") / 100).cast("int")
    return fact.groupBy(month.alias(MONTH), F.expr("bitmap_bucket_number(customer_key)").alias(BLOCK)).agg(
        F.count(F.lit(1)).alias("orders"), F.count("rating").alias("ratings"),
        *[F.sum(c).alias(c) for c in SUMS],
        F.min("date_key").alias("first_key"), F.max("date_key").alias("last_key"),
        F.expr("bitmap_construct_agg(bitmap_bit_position(customer_key))").alias(BITS))


def _build(wh: Warehouse) -> DataFrame:
    labels = wh.dim_date.select(F.floor(F.col("date_key") / 100).cast("int").alias(MONTH), "year", "quarter", "month",
                                "month_label", "quarter_label").distinct()
    # a row per calendar month
    return month_states(wh.fact).join(F.broadcast(labels), MONTH)


def states(wh: Warehouse) -> DataFrame:
    return wh.memo("month_states", lambda: _build(wh))


def roll_up(wh: Warehouse, *by: str) -> DataFrame:
    """The states of the groups ``by`` of months (none: of all), with the
    number of distinct customers as ``customers``."""
    sums = [F.sum(c).alias(c) for c in ["orders", "ratings", *SUMS]] + [
        F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key")]
    united = states(wh).groupBy(*by, BLOCK).agg(*sums, F.expr(f"bitmap_or_agg({BITS})").alias(BITS))
    return united.groupBy(*by).agg(*sums, F.coalesce(F.sum(F.expr(f"bitmap_count({BITS})")), F.lit(0)).alias("customers"))


def per_order(column: str, scale: int = 2) -> Column:
    return ratio(F.col(column), F.col("orders"), scale)


def orders() -> Column:
    return big(F.coalesce("orders", F.lit(0)))


def day(key: str) -> Column:
    return cal.key_to_date(F.col(key))
