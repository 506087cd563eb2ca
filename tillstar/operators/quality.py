"""Data profiling, cleaning and validation operators (DQ-*).

All checks are single-pass aggregates or shuffles keyed by (column, value);
per-column metrics are computed on a long (column, value) form so one job
covers every column.  Percentiles are exact (linear interpolation between
the two neighbouring order statistics, as pandas does) and distributed: the
order statistics are selected by counting ranges of values, so no column is
ever ordered or gathered into one task.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions.metrics import big, dbl, pct, snap_round
from tillstar.operators.profile import dtypes_of, profile
from tillstar.operators.selection import long_rows, quantile_positions, select_positions
from tillstar.schemas import CATEGORICAL_COLUMNS, INGEST_SEQ, RAW_COLUMNS, RAW_DEFAULTS, RAW_SALES

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
DESCRIBE_PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]


def numeric_columns(df: DataFrame) -> list:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and not f.name.startswith("_")]


def _stack(cols: list, value_fn) -> Column:
    parts = ", ".join(f"'{c}', {value_fn(c)}" for c in cols)
    return F.expr(f"stack({len(cols)}, {parts}) AS (column_name, value)")


def long_form(df: DataFrame, cols: list, as_type: str, extra: list | None = None) -> DataFrame:
    """(column_name, value[, extra...]) with every listed column cast to ``as_type``."""
    extra = extra or []
    return df.select(*extra, _stack(cols, lambda c: f"CAST(`{c}` AS {as_type})"))


# --------------------------------------------------------------------------
# exact quantiles
# --------------------------------------------------------------------------

def value_type(t: T.DataType) -> str:
    """The type in which a column's values are ordered and summed: exact for
    integers and decimals, at their own scale, DOUBLE for floating point."""
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return "DOUBLE"
    return f"DECIMAL(38,{t.scale if isinstance(t, T.DecimalType) else 0})"


def exact_quantiles(df: DataFrame, cols: list, probs: list, expected_rows: int | None = None) -> DataFrame:
    """(column_name, p, value): linear-interpolated quantiles of non-null values.

    The two neighbouring order statistics are selected by histogram refinement
    (:mod:`tillstar.operators.selection`): integers and decimals of up to 18
    digits all together as whole numbers of their last place, floating point
    and longer decimals in their own type.  NaN counts as missing."""
    kinds: dict = {}
    for c in cols:
        t = df.schema[c].dataType
        if isinstance(t, (T.FloatType, T.DoubleType)):
            kinds.setdefault("double", {})[c] = (f"CAST(`{c}` AS DOUBLE)", 0)
        elif isinstance(t, T.DecimalType) and t.precision > 18:
            kinds.setdefault(f"decimal(38,{t.scale})", {})[c] = (f"CAST(`{c}` AS DECIMAL(38,{t.scale}))", 0)
        elif isinstance(t, T.DecimalType):
            kinds.setdefault("bigint", {})[c] = (f"CAST(`{c}` * CAST({10 ** t.scale} AS DECIMAL({t.scale + 1},0)) AS BIGINT)", t.scale)
        else:
            kinds.setdefault("bigint", {})[c] = (f"CAST(`{c}` AS BIGINT)", 0)
    rows = []
    for kind, columns in kinds.items():
        counts: dict = {}

        def wanted(n, counts=counts):
            counts.update(n)
            return {c: [x for lo, hi, _ in quantile_positions(k, probs).values() for x in (lo, hi)] for c, k in n.items()}

        found = select_positions(long_rows(df, {c: sql for c, (sql, _) in columns.items()}), wanted, kind)
        for c, (_, scale) in columns.items():
            for p, (lo, hi, share) in (quantile_positions(counts[c], probs).items() if c in counts else ()):
                vlo, vhi = (float(Decimal(v).scaleb(-scale)) if kind == "bigint" else float(v)
                            for v in (found[c][lo][0], found[c][hi][0]))
                rows.append((c, float(p), vlo + (vhi - vlo) * share))
    return df.sparkSession.createDataFrame(rows, "column_name string, p double, value double")


# --------------------------------------------------------------------------
# profiling
# --------------------------------------------------------------------------

def dq_profile(df: DataFrame, cols: list | None = None) -> DataFrame:
    """DQ-1 per column: dtype, non-null, nulls, null %, distinct, first sample
    (of the lowest order_id, then ingestion sequence)."""
    cols = cols or [c for c in df.columns if not c.startswith("_")]
    return profile(df, cols).report(dtypes_of(df, cols))


def dq_numeric_summary(df: DataFrame, cols: list | None = None, expected_rows: int | None = None) -> DataFrame:
    """DQ-2 describe(): count, mean, std, min, p5..p95, max (rounded 2).
    Moments come from one wide aggregate; percentiles from exact_quantiles."""
    cols = cols or numeric_columns(df)
    aggs = []
    for c in cols:
        v = F.col(f"`{c}`")
        exact = v.cast(value_type(df.schema[c].dataType))
        aggs += [F.count(v).alias(f"n_{c}"), F.sum(exact).alias(f"s_{c}"),
                 F.stddev_samp(v.cast("double")).alias(f"sd_{c}"),
                 F.min(exact).alias(f"mn_{c}"), F.max(exact).alias(f"mx_{c}")]
    wide = df.agg(*aggs)
    base = wide.select(F.expr(
        f"stack({len(cols)}, " + ", ".join(
            f"'{c}', `n_{c}`, CAST(`s_{c}` AS DOUBLE), `sd_{c}`, CAST(`mn_{c}` AS DOUBLE), CAST(`mx_{c}` AS DOUBLE)"
            for c in cols) + ") AS (column_name, count, _s, _std, _min, _max)"))
    qs = exact_quantiles(df, cols, DESCRIBE_PROBS, expected_rows)
    wide_q = qs.groupBy("column_name").pivot("p", DESCRIBE_PROBS).agg(F.first("value"))
    names = {p: f"p{int(round(p * 100))}" for p in DESCRIBE_PROBS}
    out = base.join(wide_q, "column_name")
    return out.select(
        "column_name", big("count").alias("count"),
        snap_round(F.col("_s") / F.col("count")).alias("mean"),
        snap_round(F.col("_std")).alias("std"),
        snap_round(F.col("_min")).alias("min"),
        *[snap_round(F.col(f"`{p}`")).alias(names[p]) for p in DESCRIBE_PROBS],
        snap_round(F.col("_max")).alias("max"))


def null_counts_all(df: DataFrame, cols: list | None = None) -> DataFrame:
    cols = cols or [c for c in df.columns if not c.startswith("_")]
    one = df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(c) for c in cols])
    return one.select(_stack(cols, lambda c: f"`{c}`")).select(
        "column_name", big("value").alias("null_count"))


def dq_null_counts(df: DataFrame, cols: list | None = None) -> DataFrame:
    """DQ-3 columns with at least one null."""
    return null_counts_all(df, cols).filter(F.col("null_count") > 0)


# --------------------------------------------------------------------------
# cleaning
# --------------------------------------------------------------------------

def _columns_with_nulls(df: DataFrame, cols: list) -> list:
    # one tiny aggregate row (one value per column) on the driver
    if not cols:
        return []
    row = df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(c) for c in cols]).first()
    return [c for c in cols if (row[c] or 0) > 0]


def impute_median(df: DataFrame, cols: list | None = None, expected_rows: int | None = None) -> DataFrame:
    """DQ-4 numeric nulls <- exact column median (imputed columns become double)."""
    cols = _columns_with_nulls(df, cols or numeric_columns(df))
    if not cols:
        return df
    med = exact_quantiles(df, cols, [0.5], expected_rows)
    one = med.groupBy().pivot("column_name", cols).agg(F.first("value"))
    one = one.select(*[F.col(f"`{c}`").alias(f"_med_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(one))  # exactly one row
    for c in cols:
        out = out.withColumn(c, F.coalesce(dbl(c), F.col(f"_med_{c}")))
    return out.select(*df.columns)


def impute_mode(df: DataFrame, cols: list | None = None) -> DataFrame:
    """DQ-5 string nulls <- most frequent value (smallest value on ties).
    Value counts are a shuffled aggregate; the pick is a partial min_by."""
    cols = cols or [f.name for f in df.schema.fields
                    if isinstance(f.dataType, T.StringType) and not f.name.startswith("_")]
    cols = _columns_with_nulls(df, cols)
    if not cols:
        return df
    counts = (long_form(df, cols, "STRING").filter(F.col("value").isNotNull())
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("_c")))
    modes = counts.groupBy("column_name").agg(
        F.min_by("value", F.struct((-F.col("_c")).alias("a"), F.col("value").alias("b"))).alias("mode"))
    one = modes.groupBy().pivot("column_name", cols).agg(F.first("mode"))
    one = one.select(*[F.col(f"`{c}`").alias(f"_mode_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(one))
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_mode_{c}")))
    return out.select(*df.columns)


def as_text(df: DataFrame, cols: list | None = None) -> DataFrame:
    """Every column rendered as text: the shape of a CSV export."""
    cols = cols or RAW_COLUMNS
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols])


def parse_dates(df: DataFrame, cols=("order_date",), fmt: str = "yyyy-MM-dd") -> DataFrame:
    """DQ-6 text -> DATE (ISO, month before day); unparsable -> null."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.try_to_date(F.trim(F.col(c)), fmt))
    return out


def coerce_types(df: DataFrame, schema: T.StructType = RAW_SALES) -> DataFrame:
    """DQ-7 text columns -> schema types; unparsable numbers -> null."""
    out = []
    for f in schema.fields:
        if f.name not in df.columns:
            continue
        c = F.trim(F.col(f.name).cast("string"))
        if isinstance(f.dataType, T.DateType):
            out.append(F.try_to_date(c, "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(F.col(f.name).cast("string").alias(f.name))
        else:
            out.append(F.expr(f"try_cast(trim(CAST(`{f.name}` AS STRING)) AS {f.dataType.simpleString()})")
                       .alias(f.name))
    rest = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(*out, *rest)


def trim_strings(df: DataFrame, cols=tuple(CATEGORICAL_COLUMNS)) -> DataFrame:
    """DQ-8 strip surrounding whitespace of categorical columns."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.trim(F.col(c)))
    return out


def apply_defaults(df: DataFrame) -> DataFrame:
    out = df
    for c, v in RAW_DEFAULTS.items():
        if c in out.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(out.schema[c].dataType)))
    return out


def clean_pipeline(text_df: DataFrame, impute: bool = False) -> DataFrame:
    """Cleaning in the order that keeps coercion nulls visible to the
    imputation: coerce -> trim -> keep-first dedup -> (impute).  The input
    carries the ingestion sequence, which says what came first."""
    from tillstar.operators.dedup import dedup_keep_first
    typed = trim_strings(coerce_types(text_df))
    deduped = dedup_keep_first(typed, "order_id")
    if impute:
        deduped = impute_mode(impute_median(deduped))
    return deduped


# --------------------------------------------------------------------------
# duplicates and derived columns
# --------------------------------------------------------------------------

def dup_full_rows(df: DataFrame, cols: list | None = None) -> DataFrame:
    """DQ-9 rows beyond the first copy of an identical full row."""
    cols = cols or [c for c in df.columns if not c.startswith("_")]
    per_row = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return per_row.agg(big(F.sum("_c")).alias("total_rows"), big(F.count(F.lit(1))).alias("distinct_rows"),
                       big(F.sum(F.col("_c") - 1)).alias("full_row_duplicates"))


def dup_keys(df: DataFrame, key: str = "order_id") -> DataFrame:
    """DQ-10 rows beyond the first per key."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    return per_key.agg(big(F.sum("_c")).alias("total_rows"), big(F.count(F.lit(1))).alias("distinct_keys"),
                       big(F.sum(F.col("_c") - 1)).alias("duplicate_keys"))


def derive_date_parts(df: DataFrame, col: str = "order_date") -> DataFrame:
    """DQ-12 order_year, order_month, order_quarter, order_dow (day name)."""
    d = F.col(col)
    return (df.withColumn("order_year", F.year(d)).withColumn("order_month", F.month(d))
              .withColumn("order_quarter", F.quarter(d)).withColumn("order_dow", F.date_format(d, "EEEE")))


def revenue_mismatch(df: DataFrame, tol: str = "0.05") -> Column:
    check = F.round(F.col("discounted_price") * F.col("quantity"), 2)
    return F.abs(check - F.col("revenue")) > F.lit(tol).cast("decimal(10,2)")


def price_mismatch(df: DataFrame, tol: str = "0.10") -> Column:
    check = F.round(F.col("product_price") * (F.lit(100) - F.col("discount_percent"))
                    * F.lit("0.01").cast("decimal(3,2)"), 2)
    return F.abs(check - F.col("discounted_price")) > F.lit(tol).cast("decimal(10,2)")


def check_revenue(df: DataFrame) -> DataFrame:
    """DQ-13 |round(discounted_price * quantity, 2) - revenue| > 0.05."""
    return df.agg(big(F.count(F.lit(1))).alias("rows_checked"),
                  big(F.count(F.when(revenue_mismatch(df), 1))).alias("revenue_mismatches"))


def check_discounted_price(df: DataFrame) -> DataFrame:
    """DQ-14 |round(price * (1 - pct/100), 2) - discounted_price| > 0.10."""
    return df.agg(big(F.count(F.lit(1))).alias("rows_checked"),
                  big(F.count(F.when(price_mismatch(df), 1))).alias("price_mismatches"))


def flag_checks(df: DataFrame) -> DataFrame:
    """Row-level flags of DQ-13/14 (the notebook's check columns)."""
    return (df.withColumn("revenue_check", F.round(F.col("discounted_price") * F.col("quantity"), 2))
              .withColumn("revenue_mismatch", revenue_mismatch(df))
              .withColumn("dp_check", F.round(F.col("product_price") * (F.lit(100) - F.col("discount_percent"))
                                              * F.lit("0.01").cast("decimal(3,2)"), 2))
              .withColumn("dp_mismatch", price_mismatch(df)))


def outliers_iqr(df: DataFrame, cols: list, expected_rows: int | None = None) -> DataFrame:
    """DQ-15 per column: values outside [Q1 - 1.5 IQR, Q3 + 1.5 IQR]."""
    qs = exact_quantiles(df, cols, [0.25, 0.75], expected_rows)
    b = (qs.groupBy("column_name").pivot("p", [0.25, 0.75]).agg(F.first("value"))
           .select("column_name", F.col("`0.25`").alias("q1"), F.col("`0.75`").alias("q3")))
    b = b.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lower", F.col("q1") - 1.5 * F.col("iqr")).withColumn("upper", F.col("q3") + 1.5 * F.col("iqr"))
    # the rows stay wide: one row of bounds beside them, one aggregate over them
    of = lambda c, end: F.max(F.when(F.col("column_name") == c, F.col(end)))
    ends = b.agg(*[of(c, end).alias(f"_{end}_{c}") for c in cols for end in ("lower", "upper")])

    def outside(c: str) -> Column:
        value = F.col(f"`{c}`").cast("double")
        return (value < F.col(f"`_lower_{c}`")) | (value > F.col(f"`_upper_{c}`"))

    one = df.select(*[F.col(f"`{c}`") for c in cols]).crossJoin(F.broadcast(ends)).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.when(outside(c), 1)).alias(f"_out_{c}") for c in cols])
    each = ", ".join(f"'{c}', `_out_{c}`, _rows" for c in cols)
    counts = one.select(F.expr(f"stack({len(cols)}, {each}) AS (column_name, _out, _rows)"))
    return b.join(F.broadcast(counts), "column_name").select(  # a row per column
        "column_name", "q1", "q3", "iqr", "lower", "upper", big("_out").alias("outlier_count"),
        pct(F.col("_out"), F.col("_rows")).alias("outlier_pct"))


def value_counts(df: DataFrame, cols=tuple(CATEGORICAL_COLUMNS)) -> DataFrame:
    """DQ-16 (column, value, n) with the column's distinct-value count."""
    cols = list(cols)
    vc = long_form(df, cols, "STRING").filter(F.col("value").isNotNull()) \
        .groupBy("column_name", "value").agg(big(F.count(F.lit(1))).alias("n"))
    nd = vc.groupBy("column_name").agg(big(F.count(F.lit(1))).alias("distinct_values"))
    return vc.join(nd, "column_name").orderBy("column_name", F.desc("n"), "value")


# --------------------------------------------------------------------------
# constraints, keys, integrity
# --------------------------------------------------------------------------

NOT_NULL_COLUMNS = [f.name for f in RAW_SALES.fields if not f.nullable]


def constraint_checks(df: DataFrame, key: str = "order_id") -> DataFrame:
    """DQ-18 raw-table constraints as violation counts (no row is dropped)."""
    checks = {
        "chk_quantity_positive": ~(F.col("quantity") > 0),
        "chk_discount_range": ~F.col("discount_percent").between(0, 100),
        "chk_is_returned": ~F.col("is_returned").isin(0, 1),
        "chk_revenue_non_negative": ~(F.col("revenue") >= 0),
    }
    aggs = [big(F.count(F.lit(1))).alias("_rows"), big(F.countDistinct(key)).alias("_keys")]
    aggs += [big(F.count(F.when(c, 1))).alias(n) for n, c in checks.items()]
    aggs += [big(F.count(F.when(F.col(c).isNull(), 1))).alias(f"not_null_{c}") for c in NOT_NULL_COLUMNS
             if c in df.columns]
    one = df.agg(*aggs).withColumn("pk_raw_sales", F.col("_rows") - F.col("_keys"))
    names = ["pk_raw_sales"] + list(checks) + [f"not_null_{c}" for c in NOT_NULL_COLUMNS if c in df.columns]
    return one.select(_stack(names, lambda c: f"`{c}`")).select(
        F.col("column_name").alias("constraint_name"), big("value").alias("violations"))


def quarantine(df: DataFrame) -> DataFrame:
    """Rows breaking a row-level constraint, with the first broken rule."""
    reason = (F.when(~(F.col("quantity") > 0), "chk_quantity_positive")
              .when(~F.col("discount_percent").between(0, 100), "chk_discount_range")
              .when(~F.col("is_returned").isin(0, 1), "chk_is_returned")
              .when(~(F.col("revenue") >= 0), "chk_revenue_non_negative"))
    for c in NOT_NULL_COLUMNS:
        if c in df.columns:
            reason = reason.when(F.col(c).isNull(), f"not_null_{c}")
    return df.withColumn("_violation", reason).filter(F.col("_violation").isNotNull())


FK_CHECKS = [("date_key", "dim_date"), ("customer_key", "dim_customer"), ("product_key", "dim_product"),
             ("country_key", "dim_country"), ("traffic_source_key", "dim_traffic_source"),
             ("payment_method_key", "dim_payment_method")]


def referential_integrity(wh) -> DataFrame:
    """DQ-19 fact rows whose key has no dimension row.

    One scan of the fact: each foreign key is left-joined to its dimension's
    distinct keys (broadcast when the counted dimension is small) and one
    aggregate counts the rows that found no match, per key and overall."""
    f = wh.fact.select(*[fk for fk, _ in FK_CHECKS])
    for i, (fk, dim) in enumerate(FK_CHECKS):
        keys = wh.table(dim).select(F.col(fk).alias(f"_k{i}")).distinct().withColumn(f"_hit{i}", F.lit(True))
        keys = F.broadcast(keys) if wh.can_broadcast(dim) else keys
        f = f.join(keys, F.col(fk) == F.col(f"_k{i}"), "left")
    miss = [F.col(f"_hit{i}").isNull() for i in range(len(FK_CHECKS))]
    any_miss = miss[0]
    for m in miss[1:]:
        any_miss = any_miss | m
    one = f.agg(*[F.count(F.when(m, 1)).alias(f"o{i}") for i, m in enumerate(miss)],
                F.count(F.when(any_miss, 1)).alias("o_all"))
    parts = ", ".join(f"'fact_sales.{fk}', '{dim}', o{i}" for i, (fk, dim) in enumerate(FK_CHECKS))
    rows = one.select(F.expr(f"stack({len(FK_CHECKS) + 1}, {parts}, 'ALL', '*', o_all) "
                             f"AS (foreign_key, references, orphans)"))
    return rows.select("foreign_key", "references", big("orphans").alias("orphans"),
                       F.when(F.col("orphans") == 0, "PASS").otherwise("FAIL").alias("status"))


UNIQUE_KEYS = [("dim_date", "date_key"), ("dim_customer", "customer_key"), ("dim_customer", "customer_id"),
               ("dim_product", "product_key"), ("dim_product", "product_id"), ("dim_country", "country_key"),
               ("dim_country", "country_name"), ("dim_traffic_source", "traffic_source_key"),
               ("dim_traffic_source", "traffic_source"), ("dim_payment_method", "payment_method_key"),
               ("dim_payment_method", "payment_method"), ("fact_sales", "sales_key"), ("fact_sales", "order_id")]


def unique_key_checks(wh) -> DataFrame:
    """DQ-20 rows beyond the first per declared unique key."""
    parts = []
    for table, key in UNIQUE_KEYS:
        t = wh.fact if table == "fact_sales" else wh.table(table)
        per = t.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
        parts.append(per.agg(big(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0))).alias("duplicates"))
                     .select(F.lit(table).alias("table_name"), F.lit(key).alias("key_column"), "duplicates"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------------------------
# control totals
# --------------------------------------------------------------------------

def raw_totals(df: DataFrame) -> DataFrame:
    """DQ-21 total revenue, total profit, revenue / profit."""
    return df.agg(dbl(F.sum("revenue")).alias("total_revenue"), dbl(F.sum("profit")).alias("total_profit"),
                  (dbl(F.sum("revenue")) / F.nullif(dbl(F.sum("profit")), F.lit(0.0))).alias("revenue_profit_ratio"))


def raw_monthly(df: DataFrame, months: int = 12) -> DataFrame:
    """DQ-22 first ``months`` calendar months: revenue and profit."""
    g = df.groupBy(F.trunc("order_date", "MM").alias("order_month")).agg(
        dbl(F.sum("revenue")).alias("revenue"), dbl(F.sum("profit")).alias("profit"))
    return g.orderBy("order_month").limit(months)


def dq_scorecard(clean: DataFrame) -> DataFrame:
    """DQ-17 fourteen checks of the cleaned set.  Defect counts PASS at 0 and
    FAIL otherwise; descriptive metrics are INFO (WARN when empty)."""
    cols = [c for c in clean.columns if not c.startswith("_")]
    nulls = sum(F.sum(F.col(f"`{c}`").isNull().cast("long")) for c in cols)
    a = clean.agg(
        F.count(F.lit(1)).alias("rows"), F.min("order_date").alias("lo"), F.max("order_date").alias("hi"),
        nulls.alias("nulls"), (F.count(F.lit(1)) - F.countDistinct("order_id")).alias("dups"),
        F.count(F.when(revenue_mismatch(clean), 1)).alias("rev_mm"),
        F.count(F.when(price_mismatch(clean), 1)).alias("dp_mm"),
        F.countDistinct("customer_id").alias("customers"), F.countDistinct("product_id").alias("products"),
        F.countDistinct("product_category").alias("categories"), F.countDistinct("customer_country").alias("countries"),
        F.countDistinct("traffic_source").alias("sources"), F.countDistinct("payment_method").alias("payments"),
        pct(F.sum("is_returned"), F.count("is_returned")).alias("ret"),
        snap_round(dbl(F.sum("discount_percent")) / F.count("discount_percent")).alias("disc"))
    s = lambda c: F.col(c).cast("string")
    rows = [
        ("Total records", s("rows"), "info"),
        ("Date range", F.concat(s("lo"), F.lit(" → "), s("hi")), "info"),
        ("Null values remaining", s("nulls"), "defect"),
        ("Duplicate order_ids", s("dups"), "defect"),
        ("Revenue mismatches", s("rev_mm"), "defect"),
        ("Price mismatches", s("dp_mm"), "defect"),
        ("Unique customers", s("customers"), "info"),
        ("Unique products", s("products"), "info"),
        ("Product categories", s("categories"), "info"),
        ("Countries", s("countries"), "info"),
        ("Traffic sources", s("sources"), "info"),
        ("Payment methods", s("payments"), "info"),
        ("Return rate", F.format_string("%.2f%%", F.col("ret")), "info"),
        ("Avg discount %", F.format_string("%.2f%%", F.col("disc")), "info"),
    ]
    parts = []
    for name, val, kind in rows:
        if kind == "defect":
            status = F.when(val == "0", "PASS").otherwise("FAIL")
        else:
            status = F.when(val.isNull() | (val == "0"), "WARN").otherwise("INFO")
        parts.append(F.struct(F.lit(name).alias("check_name"), val.alias("value"), status.alias("status")))
    return a.select(F.explode(F.array(*parts)).alias("r")).select("r.*")
