"""Star-schema build: clean orders -> six dimensions + sales fact.

The build runs once per (session, source), in two steps that wait for the
first report that needs them (the cleaned orders; dimensions and fact), and is
kept for every report:
the cleaned order table and the fact are persisted (MEMORY_AND_DISK_DESER, so an
evicted or lost block is recomputed from lineage), each dimension is
counted once, and that count decides later whether a dimension is joined
by broadcast (bounded, checked size) or by a shuffled join (AQE splits
skewed keys).
"""

from __future__ import annotations

import datetime as _dt
import threading
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions import calendar as cal
from tillstar.functions import mappings as mp
from tillstar.functions.metrics import ratio
from tillstar.operators import states
from tillstar.operators.dedup import dedup_keep_first
from tillstar.operators.ranking import OrderSpec, ordered_stats
from tillstar.schemas import RAW_COLUMNS
from tillstar.session import conf_int

_LOCK = threading.RLock()

BROADCAST_MAX_ROWS_KEY = "tillstar.broadcast.maxRows"
BROADCAST_MAX_ROWS = 1_000_000

DIM_KEYS = {
    "date": ("dim_date", "date_key"),
    "customer": ("dim_customer", "customer_key"),
    "product": ("dim_product", "product_key"),
    "country": ("dim_country", "country_key"),
    "traffic_source": ("dim_traffic_source", "traffic_source_key"),
    "payment_method": ("dim_payment_method", "payment_method_key"),
}


@dataclass
class Warehouse:
    spark: SparkSession
    clean: DataFrame | None
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_country: DataFrame
    dim_traffic_source: DataFrame
    dim_payment_method: DataFrame
    fact: DataFrame
    counts: dict = field(default_factory=dict)
    raw: DataFrame | None = None
    quarantined: DataFrame | None = None
    _memo: dict = field(default_factory=dict, repr=False)
    _kept: dict = field(default_factory=dict, repr=False)

    def memo(self, name: str, build) -> DataFrame:
        """A derived table shared by several reports (RFM scores, per-product
        totals, the month series ...): built once per warehouse and persisted
        (MEMORY_AND_DISK_DESER; lost blocks recompute from lineage)."""
        with _LOCK:
            df = self._memo.get(name)
            if df is None:
                df = build().persist(StorageLevel.MEMORY_AND_DISK_DESER)
                self._memo[name] = df
            return df

    def keep(self, name: str, build):
        """A small driver-side result shared by several reports (limits of
        scores): found once per warehouse."""
        with _LOCK:
            if name not in self._kept:
                self._kept[name] = build()
            return self._kept[name]

    def release(self) -> None:
        """Unpersist every table this warehouse cached (long-lived sessions
        building several warehouses)."""
        with _LOCK:
            for df in list(self._memo.values()) + [self.raw, self.clean, self.fact, self.dim_date,
                                                   self.dim_customer, self.dim_product, self.dim_country,
                                                   self.dim_traffic_source, self.dim_payment_method]:
                if df is not None:
                    df.unpersist()
            self._memo.clear()

    def raw_lines(self) -> DataFrame:
        """The staged raw lines, persisted on first use by a report."""
        return self.memo("raw_lines", lambda: self.raw)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def tables(self) -> dict:
        names = ["fact_sales", "dim_date", "dim_customer", "dim_product", "dim_country",
                 "dim_traffic_source", "dim_payment_method"]
        return {n: (self.fact if n == "fact_sales" else getattr(self, n)) for n in names}

    def can_broadcast(self, table_name: str) -> bool:
        limit = conf_int(self.spark, BROADCAST_MAX_ROWS_KEY, BROADCAST_MAX_ROWS)
        n = self.counts.get(table_name)
        return n is not None and n <= limit

    def dim(self, short: str, *cols: str) -> DataFrame:
        """Dimension projection for a join: its key plus ``cols``; broadcast
        only when its counted row number is within the broadcast limit."""
        table_name, key = DIM_KEYS[short]
        d = getattr(self, table_name).select(key, *cols)
        return F.broadcast(d) if self.can_broadcast(table_name) else d

    def with_dims(self, df: DataFrame, **dims) -> DataFrame:
        """Join ``df`` (carrying surrogate keys) to dimension attributes:
        ``with_dims(fact, product=["product_category"], date=["year"])``."""
        out = df
        for short, cols in dims.items():
            _, key = DIM_KEYS[short]
            out = out.join(self.dim(short, *cols), on=key)
        return out

    def customer_rows(self) -> int:
        return self.counts["dim_customer"]

    def product_rows(self) -> int:
        return self.counts["dim_product"]


# --------------------------------------------------------------------------
# dimension builders
# --------------------------------------------------------------------------

def date_bounds(clean: DataFrame) -> tuple:
    """Default spine: Jan 1 of the first order year .. Dec 31 of the last."""
    row = clean.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    if lo is None:       # no order, no day
        return _dt.date(1970, 1, 1), _dt.date(1969, 12, 31)
    return _dt.date(lo.year, 1, 1), _dt.date(hi.year, 12, 31)


def date_spine(spark: SparkSession, start, end) -> DataFrame:
    """One row per day, bounds inclusive (SRC-5).  Generated from a range of
    day offsets so the rows are spread over tasks instead of exploded from
    a single array."""
    start = _dt.date.fromisoformat(str(start))
    end = _dt.date.fromisoformat(str(end))
    days = (end - start).days + 1
    return (spark.range(0, max(days, 0))
                 .select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date")))


def build_dim_date(spark: SparkSession, start, end) -> DataFrame:
    d = F.col("full_date")
    return date_spine(spark, start, end).select(
        cal.date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        cal.quarter_label(d).alias("quarter_label"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        cal.month_label(d).alias("month_label"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        (~F.dayofweek(d).isin(1, 7)).alias("is_weekday"),
        cal.fiscal_year(d).alias("fiscal_year"),
        cal.fiscal_quarter(d).alias("fiscal_quarter"),
    )


def customer_profile(clean: DataFrame) -> DataFrame:
    """Per-customer profile from order-grain rows (no surrogate key yet).

    Country is the one of the latest order, ties on the date broken by the
    highest order_id."""
    return states.customer_profile_of(states.CUSTOMER.states(clean))


def assign_key(df: DataFrame, key: str, order_cols: list, expected_rows: int | None) -> DataFrame:
    """Dense 1..n surrogate key ordered by the natural key (DIM-7)."""
    spec = OrderSpec(keys=[(c, False) for c in order_cols])
    out = ordered_stats(df, spec, row_number=key, expected_rows=expected_rows)
    return out.select(key, *df.columns)


def build_dim_customer(profile: DataFrame, n: int | None) -> DataFrame:
    keyed = assign_key(profile, "customer_key", ["customer_id"], n)
    return keyed.select(
        "customer_key", "customer_id", "customer_country", "first_order_date", "last_order_date",
        "total_orders", "total_revenue", "total_profit", "avg_order_value", "is_repeat_customer",
        F.lit(None).cast("string").alias("customer_segment"),
        "avg_rating", "customer_lifespan_days",
        F.current_timestamp().alias("_created_at"), F.current_timestamp().alias("_updated_at"))


def product_profile(clean: DataFrame) -> DataFrame:
    return states.product_profile_of(states.PRODUCT.states(clean))


def build_dim_product(profile: DataFrame, n: int | None) -> DataFrame:
    keyed = assign_key(profile, "product_key", ["product_id", "product_category"], n)
    return keyed.withColumn("_created_at", F.current_timestamp())


def _small_dim(values: DataFrame, key: str, name_col: str, attrs: dict, expected_rows: int | None = None) -> DataFrame:
    """Distinct values of a low-cardinality column + mapped attributes + key
    ordered by the value.  ``expected_rows`` (the counted combinations) bounds
    the input of the key numbering; an unknown size takes the range path."""
    out = values.select(F.col(name_col)).distinct()
    for a, expr in attrs.items():
        out = out.withColumn(a, expr)
    keyed = assign_key(out, key, [name_col], expected_rows)
    return keyed.select(F.col(key).cast("int").alias(key), name_col, *attrs)


def build_dim_country(clean: DataFrame, expected_rows: int | None = None) -> DataFrame:
    c = F.col("country_name")
    return _small_dim(clean.select(F.col("customer_country").alias("country_name")), "country_key",
                      "country_name", {"region": mp.region_of(c), "currency_code": mp.currency_of(c)},
                      expected_rows)


def build_dim_traffic_source(clean: DataFrame, expected_rows: int | None = None) -> DataFrame:
    s = F.col("traffic_source")
    return _small_dim(clean, "traffic_source_key", "traffic_source",
                      {"channel_type": mp.channel_type_of(s), "is_paid": mp.is_paid_of(s)}, expected_rows)


def build_dim_payment_method(clean: DataFrame, expected_rows: int | None = None) -> DataFrame:
    m = F.col("payment_method")
    return _small_dim(clean, "payment_method_key", "payment_method",
                      {"payment_type": mp.payment_type_of(m), "is_digital_wallet": mp.is_wallet_of(m)},
                      expected_rows)


FACT_COLUMNS = ["sales_key", "order_id", "date_key", "customer_key", "product_key", "country_key",
                "traffic_source_key", "payment_method_key", "quantity", "product_price",
                "discounted_price", "discount_percent", "discount_amount", "shipping_cost", "revenue",
                "profit", "gross_revenue", "profit_margin_pct", "rating", "is_returned"]


# What a sales row must have to find its dimension members.
NATURAL_KEYS = ["order_id", "order_date", "customer_id", "product_id", "product_category", "customer_country",
                "traffic_source", "payment_method"]


def missing_keys(df: DataFrame) -> DataFrame:
    """Adds ``missing``: the natural keys that the row lacks, as one text;
    null if it has all."""
    lacks = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in NATURAL_KEYS])
    return df.withColumn("missing", F.nullif(lacks, F.lit("")))


def split_by_keys(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that can be loaded, quarantined rows with what they lack)."""
    marked = missing_keys(clean)
    return marked.filter("missing IS NULL").drop("missing"), marked.filter("missing IS NOT NULL")


def load_audit(clean: DataFrame) -> DataFrame:
    """outcome, missing, row_count: where the cleaned rows went."""
    return (missing_keys(clean).groupBy("missing").agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.when(F.col("missing").isNull(), "loaded").otherwise("quarantined").alias("outcome"),
                    "missing", "row_count"))


def fact_rows(clean: DataFrame, dims: dict, counts: dict, spark: SparkSession, *more: str,
              known: set = frozenset()) -> DataFrame:
    """Fact rows of cleaned orders, without their sales key; ``more`` columns
    of the orders stay.  Orders have the keys of the ``known`` dimensions."""
    limit = conf_int(spark, BROADCAST_MAX_ROWS_KEY, BROADCAST_MAX_ROWS)

    def side(name, df):
        return F.broadcast(df) if counts.get(name, limit + 1) <= limit else df

    cust = side("dim_customer", dims["dim_customer"].select("customer_id", "customer_key"))
    prod = side("dim_product", dims["dim_product"].select("product_id", "product_category", "product_key"))
    ctry = side("dim_country", dims["dim_country"].select(
        F.col("country_name").alias("customer_country"), "country_key"))
    src = side("dim_traffic_source", dims["dim_traffic_source"].select("traffic_source", "traffic_source_key"))
    pay = side("dim_payment_method", dims["dim_payment_method"].select("payment_method", "payment_method_key"))
    f = clean if "dim_customer" in known else clean.join(cust, "customer_id")
    f = f if "dim_product" in known else f.join(prod, ["product_id", "product_category"])
    f = (f.join(ctry, "customer_country")
              .join(src, "traffic_source")
              .join(pay, "payment_method"))
    return f.select(
        "order_id",
        cal.date_key(F.col("order_date")).alias("date_key"),
        "customer_key", "product_key", "country_key", "traffic_source_key", "payment_method_key",
        "quantity", "product_price", "discounted_price", "discount_percent",
        F.round((F.col("product_price") - F.col("discounted_price")) * F.col("quantity"), 2)
         .cast("decimal(12,2)").alias("discount_amount"),
        "shipping_cost", "revenue", "profit",
        F.round(F.col("product_price") * F.col("quantity"), 2).cast("decimal(12,2)").alias("gross_revenue"),
        F.round(F.col("profit") / F.nullif(F.col("revenue"), F.lit(0)), 4).cast("decimal(7,4)")
         .alias("profit_margin_pct"),
        "rating", "is_returned", *more)


def build_fact(clean: DataFrame, dims: dict, counts: dict, spark: SparkSession,
               expected_rows: int | None) -> DataFrame:
    """The fact of cleaned orders, one row an order: their wide rows stay where
    they are, order ids meet their keys apart and come back to them."""
    limit = conf_int(spark, BROADCAST_MAX_ROWS_KEY, BROADCAST_MAX_ROWS)
    known = set()
    keys = ordered_stats(clean.select("order_id"), OrderSpec(keys=[("order_id", False)]), row_number="sales_key",
                         expected_rows=expected_rows)
    for name, key, natural in (("dim_customer", "customer_key", ["customer_id"]),
                               ("dim_product", "product_key", ["product_id", "product_category"])):
        if counts.get(name, limit + 1) > limit:
            found = clean.select("order_id", *natural).join(dims[name].select(*natural, key), natural)
            keys = keys.join(found.select("order_id", key), "order_id")
            known.add(name)
    f = fact_rows(clean.join(keys, "order_id"), dims, counts, spark, "sales_key", known=known)
    return f.select(*FACT_COLUMNS, F.current_timestamp().alias("_loaded_at"))


def clean_orders(raw: DataFrame) -> DataFrame:
    """Order grain: keep-first per order_id (the SQL path's raw table)."""
    return dedup_keep_first(raw, "order_id").select(*RAW_COLUMNS)


def clean_part(orders: DataFrame) -> tuple[dict, dict, tuple]:
    """The cleaned orders (persisted) and the quarantined ones, their counts,
    and the dates of the first and last order."""
    every = orders.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    clean, quarantined = split_by_keys(every)
    # one job: the row counts and the date bounds of the spine
    whole = missing_keys(every)
    ok = F.col("missing").isNull()
    row = whole.agg(F.count(F.when(ok, 1)).alias("n"), F.count(F.when(~ok, 1)).alias("bad"),
                    F.min(F.when(ok, F.col("order_date"))).alias("lo"),
                    F.max(F.when(ok, F.col("order_date"))).alias("hi")).first()
    counts = {"clean": row["n"], "quarantined": row["bad"]}
    return {"clean": clean, "quarantined": quarantined}, counts, (row["lo"], row["hi"])


def star_part(spark: SparkSession, clean: DataFrame, counts: dict, dates: tuple, start=None, end=None) -> dict:
    """Dimensions and fact of cleaned orders, persisted; their row counts are
    added to ``counts``."""
    import time as _time
    level = StorageLevel.MEMORY_AND_DISK_DESER
    phases, t0 = counts.setdefault("_build_phases", {}), [_time.time()]

    def lap(name):
        now = _time.time()
        phases[name] = round(now - t0[0], 3)
        t0[0] = now
    if start is None or end is None:
        if dates[0] is None:
            lo, hi = date_bounds(clean)
        else:
            lo, hi = _dt.date(dates[0].year, 1, 1), _dt.date(dates[1].year, 12, 31)
        start, end = start or lo, end or hi
    dim_date = build_dim_date(spark, start, end).persist(level)
    counts["dim_date"] = (_dt.date.fromisoformat(str(end)) - _dt.date.fromisoformat(str(start))).days + 1

    # Each dimension's row count is known without a job of its own: keys are
    # added row for row to the counted profiles, and the small dimensions are
    # bounded by the counted (country, channel, payment) combinations.  The
    # persisted dimensions materialize inside the fact build that joins them.
    cprof = customer_profile(clean).persist(level)
    n_cust = cprof.count()
    lap("customer_profile")
    dim_customer = build_dim_customer(cprof, n_cust).persist(level)
    counts["dim_customer"] = n_cust
    pprof = product_profile(clean).persist(level)
    n_prod = pprof.count()
    lap("product_profile")
    dim_product = build_dim_product(pprof, n_prod).persist(level)
    counts["dim_product"] = n_prod
    dims = {"dim_customer": dim_customer, "dim_product": dim_product}
    # the three small dimensions come from ONE scan: the distinct
    # (country, channel, payment) combinations (at most the product of the
    # three value counts), checked by count before use
    combos = clean.select("customer_country", "traffic_source", "payment_method").distinct().persist(level)
    counts["_combos"] = combos.count()
    lap("small_dims")
    for name, builder in [("dim_country", build_dim_country), ("dim_traffic_source", build_dim_traffic_source),
                          ("dim_payment_method", build_dim_payment_method)]:
        dims[name] = builder(combos, counts["_combos"]).persist(level)
        counts[name] = counts["_combos"]  # upper bound of the distinct values
    fact = build_fact(clean, dims, counts, spark, counts["clean"]).persist(level)
    counts["fact_sales"] = fact.count()
    if counts["fact_sales"] != counts["clean"]:
        raise ValueError(f"{counts['clean']} rows to load, {counts['fact_sales']} loaded")
    lap("fact_and_dims")
    for name in ("dim_country", "dim_traffic_source", "dim_payment_method"):
        counts[name] = dims[name].count()  # exact, from the cache just filled
    combos.unpersist()
    cprof.unpersist()
    pprof.unpersist()
    lap("finish")
    return {"dim_date": dim_date, "fact": fact, **dims}


def build_warehouse(spark: SparkSession, raw: DataFrame, start=None, end=None) -> Warehouse:
    import time as _time
    t0 = _time.time()
    parts, counts, dates = clean_part(clean_orders(raw))
    counts["_build_phases"] = {"stage_dedup_clean": round(_time.time() - t0, 3)}
    star = star_part(spark, parts["clean"], counts, dates, start, end)
    return Warehouse(spark=spark, counts=counts, raw=raw, **parts, **star)


class StagedWarehouse(Warehouse):
    """A warehouse of raw lines that cleans the orders and builds the star when
    a report first asks for them: a report on raw lines pays for neither."""

    CLEAN = ("clean", "quarantined", "_dates")
    STAR = ("fact", *[table for table, _ in DIM_KEYS.values()])

    def __init__(self, spark: SparkSession, raw: DataFrame, orders: DataFrame | None = None):
        """``orders``: the rows of ``clean_orders(raw)``, if they can be made
        with less work than from the raw lines."""
        self.spark, self.raw, self._memo, self._kept = spark, raw, {}, {}
        self._orders = orders

    def __getattribute__(self, name):
        found = object.__getattribute__(self, "__dict__")
        if name not in found:
            if name in StagedWarehouse.CLEAN:
                self._clean()
            elif name in StagedWarehouse.STAR or name == "counts":
                self._star()
        return object.__getattribute__(self, name)

    def _clean(self) -> None:
        with _LOCK:
            if "clean" not in self.__dict__:
                # raw lines that a report has kept are read, not staged again
                kept = self._orders is None or "raw_lines" in self._memo
                parts, self._clean_counts, dates = clean_part(clean_orders(self.raw) if kept else self._orders)
                self.__dict__.update(parts, _dates=dates)

    def _star(self) -> None:
        with _LOCK:
            if "counts" not in self.__dict__:
                clean, counts = self.clean, dict(self._clean_counts)
                star = star_part(self.spark, clean, counts, self._dates)
                self.__dict__.update(star, counts=counts)

    def release(self) -> None:
        with _LOCK:
            kept = [self.__dict__.get(n) for n in ("raw", "clean", *self.STAR)]
            for df in [*self._memo.values(), *kept]:
                if df is not None:
                    df.unpersist()
            self._memo.clear()


def open_warehouse(spark: SparkSession, base: str, fmt: str = "parquet") -> Warehouse:
    """A star written by ``write_warehouse``, ready for every report that reads
    the star (not for the reports on raw or cleaned lines)."""
    from tillstar.sources.readers import load_warehouse
    level = StorageLevel.MEMORY_AND_DISK_DESER
    tables = {n: df.persist(level) for n, df in load_warehouse(spark, base, fmt).items()}
    fact = tables.pop("fact_sales")
    counts = {n: df.count() for n, df in {**tables, "fact_sales": fact}.items()}
    return Warehouse(spark=spark, clean=None, fact=fact.select(*FACT_COLUMNS, "_loaded_at"), counts=counts, **tables)


_CACHE: dict = {}


def warehouse_for(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The star for the test tables under ``sf_dir``, each part built once per
    session, when it is first asked for."""
    from tillstar.sources.staging import sales_lines, sales_rows
    key = (spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
    with _LOCK:
        wh = _CACHE.get(key)
        if wh is None:
            lines = sales_lines(spark, sf_dir)
            # the first line of an order is found among lines, and only it is mapped
            orders = sales_rows(dedup_keep_first(lines, "order_id")).select(*RAW_COLUMNS)
            wh = StagedWarehouse(spark, sales_rows(lines), orders)
            _CACHE[key] = wh
        return wh


def enriched(wh: Warehouse) -> DataFrame:
    """FACT-2: fact joined to date, product, country, channel and payment
    attributes -- the wide table of the notebook analyses."""
    return wh.with_dims(
        wh.fact,
        date=["year", "month", "month_label", "quarter_label", "full_date"],
        product=["product_category"],
        country=["country_name", "region"],
        traffic_source=["traffic_source", "channel_type", "is_paid"],
        payment_method=["payment_method"],
    )
