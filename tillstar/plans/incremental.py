"""A stored star that is loaded again and again.

A load takes the whole sales export, as the first one does, and brings the
stored tables to the same content as a build from nothing, but for the keys:
members and orders that are known keep theirs, new ones are numbered after the
highest.  Only the months whose lines have changed are worked on:

1. The cleaned orders are staged by month, each month with an order-free hash
   of its rows; the months that differ from the stored hashes are the changed
   ones, stored months without rows the removed ones.
2. Members of changed months that the key registries lack get keys
   (``operators.keys``).
3. Fact rows and the monthly states of customers and products
   (``operators.states``) of the changed months replace their partitions;
   partitions of removed months go.
4. Members with a state in a replaced month are added up anew from their
   monthly states; all others are merged from their old total and the new
   states.  Dimensions are read off the totals and switched in one step each.

A load may fail at any step and be run again: registries only grow; before a
partition is replaced its months are marked as not loaded and its members as
pending, and both marks go with the last step.  A failed load leaves every
table readable.

Edge cases: rows without a natural key go to the table ``quarantine``; an
export without rows empties the fact; a load of the same lines rewrites
nothing; members without orders leave the customer and product dimensions but
keep their key; countries, channels and payment methods once seen stay."""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions import mappings as mp
from tillstar.operators import keys, states
from tillstar.plans.warehouse import FACT_COLUMNS, Warehouse, build_dim_date, clean_orders, fact_rows, split_by_keys
from tillstar.sources import tables

MONTH = "order_month"
SMALL = {
    "dim_country": ("country_key", "country_name", "customer_country",
                    {"region": mp.region_of, "currency_code": mp.currency_of}),
    "dim_traffic_source": ("traffic_source_key", "traffic_source", "traffic_source",
                           {"channel_type": mp.channel_type_of, "is_paid": mp.is_paid_of}),
    "dim_payment_method": ("payment_method_key", "payment_method", "payment_method",
                           {"payment_type": mp.payment_type_of, "is_digital_wallet": mp.is_wallet_of}),
}
MEMBERS = {
    "dim_customer": ("customer_key", states.CUSTOMER, states.customer_profile_of),
    "dim_product": ("product_key", states.PRODUCT, states.product_profile_of),
}


def month_of(date: Column) -> Column:
    return (F.year(date) * 100 + F.month(date)).cast("int")


def month_hashes(orders: DataFrame) -> DataFrame:
    """order_month, row_count, and two order-free hashes of the rows."""
    row = F.xxhash64(*[c for c in orders.columns if c != MONTH])
    return orders.groupBy(MONTH).agg(F.count(F.lit(1)).alias("row_count"), F.bit_xor(row).alias("xor_hash"),
                                     F.sum(row.cast("decimal(20,0)")).cast("decimal(38,0)").alias("sum_hash"))


@dataclass(frozen=True)
class Load:
    """What a load did: months rewritten, months removed, months left alone."""

    rewritten: list
    removed: list
    kept: list
    quarantined: int


class IncrementalStar:
    """Tables ``<name>_<table>`` of the session's catalog, files below ``base``."""

    def __init__(self, spark: SparkSession, base: str, name: str):
        self.spark, self.base, self.name = spark, base.rstrip("/"), name

    def names(self) -> list[str]:
        small = [f"keys_{t}" for t in (*SMALL, *MEMBERS)]
        per_member = [f"{t}_{part}" for t in MEMBERS for part in ("months", "totals", "pending")]
        return ["fact_sales", "dim_date", *SMALL, *MEMBERS, *small, *per_member, "months", "loads", "quarantine"]

    def full(self, table: str) -> str:
        return f"{self.name}_{table}"

    def has(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.full(table))

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.full(table))

    def drop(self) -> None:
        """Take the tables out of the catalog; the files stay."""
        tables.drop_tables(self.spark, [self.full(t) for t in self.names()])

    # --- steps of a load ------------------------------------------------------

    def _switch(self, df: DataFrame, table: str) -> DataFrame:
        return tables.switch_table(df, self.full(table), f"{self.base}/{table}")

    def _partitioned(self, table: str, like: DataFrame) -> DataFrame:
        return tables.partitioned_table(self.spark, self.full(table), f"{self.base}/{table}", like, MONTH)

    def _append(self, df: DataFrame, table: str) -> None:
        if not self.has(table):
            self._switch(df.limit(0), table)
        df.select(*self.table(table).columns).write.insertInto(self.full(table))

    def _months(self) -> dict:
        if not self.has("months"):
            return {}
        return {r[MONTH]: (r["row_count"], r["xor_hash"], r["sum_hash"]) for r in self.table("months").collect()}

    def _register(self, table: str, members: DataFrame, natural: list, key: str, kind: str) -> DataFrame:
        """The registry with all members of ``members``."""
        name = f"keys_{table}"
        schema = members.select(*natural, F.lit(None).cast(kind).alias(key)).limit(0)
        known = self.table(name) if self.has(name) else schema
        fresh = keys.unknown_members(known, members, natural)
        self._append(keys.next_keys(fresh, natural, key, keys.highest(known, key), kind), name)
        return self.table(name)

    def load(self, raw: DataFrame) -> Load:
        """Bring the star to the content of ``raw``."""
        stage = f"{self.base}/stage-{uuid.uuid4().hex[:12]}"
        try:
            return self._load(raw, stage)
        finally:
            tables.delete_path(self.spark, stage)

    def _load(self, raw: DataFrame, stage: str) -> Load:
        spark = self.spark
        whole, lacking = split_by_keys(clean_orders(raw).transform(self._stored(f"{stage}/orders")))
        orders = whole.withColumn(MONTH, month_of(F.col("order_date"))).repartitionByRange("order_date", "order_id") \
            .transform(self._stored(f"{stage}/months", MONTH))
        quarantined = self._switch(lacking, "quarantine").count()
        hashes = month_hashes(orders).transform(self._stored(f"{stage}/hashes"))
        old = self._months()
        new = {r[MONTH]: (r["row_count"], r["xor_hash"], r["sum_hash"]) for r in hashes.collect()}
        changed = sorted(m for m in new if new[m] != old.get(m))
        removed = sorted(m for m in old if m not in new)
        if old and not changed and not removed:
            return Load([], [], sorted(new), quarantined)
        delta = orders.filter(F.col(MONTH).isin(changed))

        registries = {t: self._register(t, delta, list(spec.keys), key, "bigint") for t, (key, spec, _) in MEMBERS.items()}
        for t, (key, column, source, _) in SMALL.items():
            registries[t] = self._register(t, delta.select(F.col(source).alias(column)), [column], key, "int")
        fresh = {t: spec.states(delta, MONTH) for t, (_, spec, _) in MEMBERS.items()}
        for t, (_, spec, _) in MEMBERS.items():
            stored = self._partitioned(f"{t}_months", fresh[t].select(*spec.keys, *spec.parts, MONTH))
            self._append(stored.filter(F.col(MONTH).isin(changed + removed)).select(*spec.keys).distinct(), f"{t}_pending")
        fact, high = self._fact(delta, registries, changed + removed, stage)
        # from here on the changed months count as not loaded until the end
        marked = hashes.filter(~F.col(MONTH).isin(changed)).unionByName(spark.createDataFrame(
            [(m, None, None, None) for m in changed + removed], hashes.schema))
        self._switch(marked, "months")
        for table, rows in [("fact_sales", fact), *((f"{t}_months", s) for t, s in fresh.items())]:
            tables.replace_partitions(rows, self.full(table), MONTH)
            tables.drop_partitions(spark, self.full(table), MONTH, removed)
        for t in MEMBERS:
            self._dimension(t, changed)
        for t, (key, column, _, attributes) in SMALL.items():
            self._switch(registries[t].select(key, column, *[f(F.col(column)).alias(a) for a, f in attributes.items()]), t)
        lo, hi = (min(new) // 100, max(new) // 100) if new else (1970, 1969)
        self._switch(build_dim_date(spark, _dt.date(lo, 1, 1), _dt.date(hi, 12, 31)), "dim_date")
        self._switch(hashes, "months")
        for t in MEMBERS:
            self._switch(self.table(f"{t}_pending").limit(0), f"{t}_pending")
        self._append(spark.createDataFrame([(high, len(changed), len(removed))],
                                           "sales_key_high bigint, rewritten int, removed int"), "loads")
        return Load(changed, removed, sorted(set(new) - set(changed)), quarantined)

    def _stored(self, path: str, by: str | None = None):
        def write(df: DataFrame) -> DataFrame:
            schema = df.schema
            writer = df.write.partitionBy(by) if by else df.write
            writer.parquet(path)
            return self.spark.read.schema(schema).parquet(path)
        return write

    def _fact(self, delta: DataFrame, registries: dict, replaced: list, stage: str) -> tuple[DataFrame, int]:
        """Fact rows of the changed months, and the highest sales key in use.

        An order keeps its key if it stands in a month that is replaced: it
        can have come from nowhere else."""
        counts = {t: df.count() for t, df in registries.items()}
        rows = fact_rows(delta, registries, counts, self.spark, MONTH)
        stamped = rows.withColumn("_loaded_at", F.current_timestamp())
        layout = stamped.withColumn("sales_key", F.lit(0).cast("bigint")).select(*FACT_COLUMNS, "_loaded_at", MONTH)
        stored = self._partitioned("fact_sales", layout)
        high = keys.highest(stored, "sales_key")
        if self.has("loads"):
            high = max(high, keys.highest(self.table("loads"), "sales_key_high"))
        ids = delta.select("order_id")
        known = stored.filter(F.col(MONTH).isin(replaced)).select("order_id", "sales_key").join(ids, "order_id", "left_semi")
        fresh = keys.next_keys(ids.join(known.select("order_id"), "order_id", "left_anti"), ["order_id"], "sales_key", high)
        numbered = known.unionByName(fresh).transform(self._stored(f"{stage}/sales_keys"))
        fact = stamped.join(numbered, "order_id").select(*FACT_COLUMNS, "_loaded_at", MONTH)
        return fact, max(high, keys.highest(numbered, "sales_key"))

    def _dimension(self, table: str, changed: list) -> None:
        """Totals of the members, and the dimension read off them."""
        key, spec, profile = MEMBERS[table]
        by = list(spec.keys)
        months, pending = self.table(f"{table}_months"), self.table(f"{table}_pending").distinct()
        parts = [months.filter(F.col(MONTH).isin(changed)),
                 months.filter(~F.col(MONTH).isin(changed)).join(pending, by, "left_semi")]
        if self.has(f"{table}_totals"):
            parts.append(self.table(f"{table}_totals").join(pending, by, "left_anti"))
        totals = self._switch(spec.merge(*parts), f"{table}_totals")
        members = profile(totals).join(self.table(f"keys_{table}"), by)
        now = F.current_timestamp()
        kept = {"_created_at": now, "_updated_at": now}
        if table == "dim_customer":
            kept = {"customer_segment": F.lit(None).cast("string")} | kept
        if self.has(table):
            before = self.table(table).select(key, *[F.col(c).alias(f"old_{c}") for c in kept if c != "_updated_at"])
            members = members.join(before, key, "left")
            kept = {c: v if c == "_updated_at" else F.coalesce(f"old_{c}", v) for c, v in kept.items()}
        self._switch(members.select(key, *profile(totals).columns, *[v.alias(c) for c, v in kept.items()]), table)

    # --- reading ----------------------------------------------------------------

    def warehouse(self) -> Warehouse:
        """The star for the reports that read it."""
        dims = {t: self.table(t) for t in ("dim_date", *SMALL, *MEMBERS)}
        fact = self.table("fact_sales")
        counts = {t: df.count() for t, df in {**dims, "fact_sales": fact}.items()}
        return Warehouse(spark=self.spark, clean=None, fact=fact.select(*FACT_COLUMNS, "_loaded_at"), counts=counts, **dims)
