"""Mergeable member states: what a customer or product has summed up to.

A state holds sums, counts, extremes and the latest order, so two states of
one member make the state of both parts together: ``merge`` of the states of
any cut of the orders equals the state of all orders.  Profiles (averages,
rates, spans) are read off a state and never stored on their own."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.metrics import ratio

_COUNT = "bigint"


@dataclass(frozen=True)
class StateSpec:
    """Key columns of a member; name -> (aggregate over orders, how two merge)."""

    keys: tuple
    parts: dict

    def states(self, orders: DataFrame, *by: str) -> DataFrame:
        """States of the members among order-grain rows, apart for each ``by``."""
        return orders.groupBy(*self.keys, *by).agg(*[made().alias(name) for name, (made, _) in self.parts.items()])

    def merge(self, *states: DataFrame) -> DataFrame:
        """One state for each member of any of ``states``."""
        columns = [*self.keys, *self.parts]
        every = reduce(DataFrame.unionByName, [s.select(*columns) for s in states])
        kinds = states[0].schema
        return every.groupBy(*self.keys).agg(
            *[joined(F.col(name)).cast(kinds[name].dataType).alias(name) for name, (_, joined) in self.parts.items()])


def _sum(column: str, kind: str):
    return (lambda: F.sum(column).cast(kind)), F.sum


CUSTOMER = StateSpec(("customer_id",), {
    "orders": ((lambda: F.count(F.lit(1))), F.sum),
    "revenue": _sum("revenue", "decimal(22,2)"),
    "profit": _sum("profit", "decimal(22,2)"),
    "rating_sum": _sum("rating", "decimal(13,1)"),
    "ratings": ((lambda: F.count("rating")), F.sum),
    "first_date": ((lambda: F.min("order_date")), F.min),
    "last_date": ((lambda: F.max("order_date")), F.max),
    # of the latest order, the highest order id on a tie
    "latest": ((lambda: F.max(F.struct("order_date", "order_id", "customer_country"))), F.max),
})

PRODUCT = StateSpec(("product_id", "product_category"), {
    "orders": ((lambda: F.count(F.lit(1))), F.sum),
    "price_sum": _sum("product_price", "decimal(20,2)"),
    "discount_sum": _sum("discount_percent", "decimal(15,2)"),
    "units": _sum("quantity", _COUNT),
    "revenue": _sum("revenue", "decimal(22,2)"),
    "profit": _sum("profit", "decimal(22,2)"),
    "returns": _sum("is_returned", _COUNT),
    "rating_sum": _sum("rating", "decimal(13,1)"),
    "ratings": ((lambda: F.count("rating")), F.sum),
})


def _rate(part: str, whole: str, kind: str, scale: int = 2) -> Column:
    return ratio(F.col(part), F.col(whole), scale).cast(kind)


def customer_profile_of(states: DataFrame) -> DataFrame:
    """The customer dimension's columns, without its key."""
    return states.select(
        "customer_id",
        F.col("latest.customer_country").alias("customer_country"),
        F.col("first_date").alias("first_order_date"),
        F.col("last_date").alias("last_order_date"),
        F.col("orders").alias("total_orders"),
        F.col("revenue").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        _rate("revenue", "orders", "decimal(10,2)").alias("avg_order_value"),
        _rate("rating_sum", "ratings", "decimal(3,2)").alias("avg_rating"),
        (F.col("orders") > 1).alias("is_repeat_customer"),
        F.datediff("last_date", "first_date").alias("customer_lifespan_days"))


def product_profile_of(states: DataFrame) -> DataFrame:
    """The product dimension's columns, without its key."""
    return states.select(
        "product_id", "product_category",
        _rate("price_sum", "orders", "decimal(10,2)").alias("avg_list_price"),
        _rate("discount_sum", "orders", "decimal(5,2)").alias("avg_discount_pct"),
        F.col("units").alias("total_units_sold"),
        F.col("revenue").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        _rate("returns", "orders", "decimal(5,4)", 4).alias("return_rate"),
        _rate("rating_sum", "ratings", "decimal(3,2)").alias("avg_rating"),
        F.col("orders").alias("order_count"))
