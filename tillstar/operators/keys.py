"""Stored surrogate keys: a member keeps the key of its first load.

A registry is a table of natural key columns and the key.  Members that it
lacks are found by an anti-join and numbered, in the order of their natural
key, from the highest key on; nothing that is stored ever changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.operators.ranking import OrderSpec, ordered_stats


def highest(registry: DataFrame, key: str) -> int:
    return registry.agg(F.max(key)).first()[0] or 0


def unknown_members(registry: DataFrame, members: DataFrame, natural: list) -> DataFrame:
    """Distinct members (null keys left out) without a key."""
    whole = members.select(*natural).dropna().distinct()
    return whole.join(registry.select(*natural), natural, "left_anti")


def next_keys(members: DataFrame, natural: list, key: str, after: int, kind: str = "bigint",
              expected_rows: int | None = None) -> DataFrame:
    """natural key, key: ``members`` numbered after ``after``."""
    numbered = ordered_stats(members, OrderSpec([(c, False) for c in natural]), row_number="_place",
                             expected_rows=expected_rows)
    return numbered.select(*natural, (F.lit(after) + F.col("_place")).cast(kind).alias(key))
