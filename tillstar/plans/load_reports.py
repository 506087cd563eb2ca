"""The star after a second load, and what the load did.

The first export is the raw lines as they may have been earlier: without the
last month, and in the first month without every third order and with other
values for another third.  The second export is the raw lines themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.metrics import big
from tillstar.operators import states
from tillstar.plans.incremental import MONTH, IncrementalStar, month_of
from tillstar.plans.quality_reports import normalized
from tillstar.plans.warehouse import Warehouse
from tillstar.session import scratch_path

AUDIT = ["_created_at", "_updated_at", "_loaded_at"]


def earlier_export(wh: Warehouse) -> DataFrame:
    """The raw lines as the first load saw them."""
    raw = wh.raw_lines()      # before the cleaned orders, which then read the kept lines too
    row = wh.clean.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).first()
    lo, hi = (d.year * 100 + d.month if d else 0 for d in (row["lo"], row["hi"]))
    month, third = month_of(F.col("order_date")), F.pmod(F.col("order_id"), F.lit(3))
    kept = raw.filter((month != hi) & ~((month == lo) & (third == 0)))
    other = (month == lo) & (third == 1)
    return kept.withColumns({
        "customer_country": F.when(other, "UK").otherwise(F.col("customer_country")),
        "rating": F.when(~other, F.col("rating")),
        "quantity": F.when(other, F.col("quantity") + 1).otherwise(F.col("quantity"))})


def twice_loaded(wh: Warehouse) -> tuple[IncrementalStar, object]:
    """The star after both loads, and the time between them."""
    def build():
        base = scratch_path(wh.spark, "incremental")
        star = IncrementalStar(wh.spark, base, "star_" + base.rsplit("-", 1)[-1])
        star.load(earlier_export(wh))
        began = wh.spark.range(1).select(F.current_timestamp()).first()[0]
        star.load(wh.raw_lines())
        return star, began
    return wh.keep("twice_loaded", build)


def _table(wh: Warehouse, name: str) -> DataFrame:
    df = twice_loaded(wh)[0].table(name)
    return normalized(df.drop(*AUDIT))


def second_load_fact(wh: Warehouse) -> DataFrame:
    """SNK-4, DIM-7: the fact after the second load; known orders keep their key."""
    return _table(wh, "fact_sales").drop(MONTH)


def second_load_customers(wh: Warehouse) -> DataFrame:
    """DIM-2, DIM-7: customers from states merged over both loads."""
    return _table(wh, "dim_customer")


def second_load_products(wh: Warehouse) -> DataFrame:
    """DIM-3, DIM-7: products from states merged over both loads."""
    return _table(wh, "dim_product")


def second_load_partitions(wh: Warehouse) -> DataFrame:
    """SNK-4: rows of every month partition, and whether the second load wrote
    it, by the load time of its rows."""
    star, began = twice_loaded(wh)
    return star.table("fact_sales").groupBy(big(MONTH).alias(MONTH)).agg(
        big(F.count(F.lit(1))).alias("row_count"), (F.max("_loaded_at") >= F.lit(began)).alias("rewritten"))


def key_registry(wh: Warehouse) -> DataFrame:
    """DIM-7: the stored keys of all members, by dimension."""
    star = twice_loaded(wh)[0]
    out = None
    for name, natural, key in (("dim_customer", ["customer_id"], "customer_key"),
                               ("dim_product", ["product_id", "product_category"], "product_key"),
                               ("dim_country", ["country_name"], "country_key"),
                               ("dim_traffic_source", ["traffic_source"], "traffic_source_key"),
                               ("dim_payment_method", ["payment_method"], "payment_method_key")):
        part = star.table(f"keys_{name}").select(
            F.lit(name).alias("dimension"), F.concat_ws("/", *[F.col(c).cast("string") for c in natural]).alias("member"),
            big(key).alias("member_key"))
        out = part if out is None else out.unionByName(part)
    return out


def merged_customer_states(wh: Warehouse) -> DataFrame:
    """DIM-2: the states of two parts of the orders (odd and even ids) merged."""
    parts = [wh.clean.filter(F.pmod(F.col("order_id"), F.lit(2)) == k) for k in (0, 1)]
    merged = states.CUSTOMER.merge(*[states.CUSTOMER.states(p) for p in parts])
    return normalized(states.customer_profile_of(merged))


VIEWS = {f.__name__: f for f in (second_load_fact, second_load_customers, second_load_products, second_load_partitions,
                                 key_registry, merged_customer_states)}
