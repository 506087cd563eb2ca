"""Data-quality reports over the staged raw lines, the cleaned orders and
the star (DQ-1 .. DQ-24)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions.metrics import big, dbl, pct
from tillstar.operators import quality as q
from tillstar.operators.profile import ProfileStore, dtypes_of
from tillstar.plans.warehouse import Warehouse
from tillstar.schemas import CATEGORICAL_COLUMNS, INGEST_SEQ, OUTLIER_COLUMNS, RAW_COLUMNS
from tillstar.session import scratch_path


def normalized(df: DataFrame) -> DataFrame:
    """Report types: DECIMAL -> DOUBLE, small integers -> BIGINT."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def _raw(wh: Warehouse) -> DataFrame:
    """Staged raw lines (order_id repeats) with the ingestion sequence."""
    return wh.raw_lines().select(*RAW_COLUMNS, INGEST_SEQ)


def _raw17(wh: Warehouse) -> DataFrame:
    return wh.raw_lines().select(*RAW_COLUMNS)


def dq_profile(wh):
    return q.dq_profile(_raw(wh), RAW_COLUMNS)


def dq_profile_by_file(wh: Warehouse) -> DataFrame:
    """DQ-1 over files that arrive in two lots: the second profile reads the
    new files only and merges their states with the stored ones."""
    spark, landing = wh.spark, scratch_path(wh.spark, "landed")
    store = ProfileStore(spark, scratch_path(spark, "profile"))
    schema, odd = _raw(wh).schema, F.pmod(F.col("order_id"), F.lit(2)) == 1
    read = lambda files: spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for k, lot in enumerate((_raw(wh).filter(odd), _raw(wh).filter(~odd))):
        lot.write.mode("append").parquet(landing)
        files = spark.read.schema(schema).parquet(landing).inputFiles()
        state, fresh = store.update(files, read, RAW_COLUMNS)
        if k and len(fresh) >= len(files):
            raise ValueError("files profiled before were read again")
    return state.report(dtypes_of(_raw(wh), RAW_COLUMNS))


def dq_numeric_summary(wh):
    return q.dq_numeric_summary(_raw17(wh))


def dq_null_counts(wh):
    return q.dq_null_counts(_raw17(wh))


def impute_median(wh):
    return normalized(q.impute_median(_raw17(wh)))


def impute_mode(wh):
    return normalized(q.impute_mode(_raw17(wh)))


def parse_dates(wh):
    t = q.as_text(_raw17(wh), ["order_id", "order_date"])
    return q.parse_dates(t).select(big("order_id").alias("order_id"), "order_date")


def coerce_types(wh):
    return normalized(q.coerce_types(q.as_text(_raw17(wh))))


def trim_strings(wh):
    t = q.as_text(_raw17(wh), ["order_id"] + CATEGORICAL_COLUMNS)
    return q.trim_strings(t).withColumn("order_id", big("order_id"))


def dup_full_rows(wh):
    return q.dup_full_rows(_raw17(wh))


def dup_keys(wh):
    return q.dup_keys(_raw17(wh))


def dedup_keep_first(wh):
    return normalized(wh.clean)


def derive_date_parts(wh):
    return normalized(q.derive_date_parts(wh.clean))


def check_revenue(wh):
    return q.check_revenue(wh.clean)


def check_discounted_price(wh):
    return q.check_discounted_price(wh.clean)


def outliers_iqr(wh):
    return q.outliers_iqr(wh.clean, OUTLIER_COLUMNS, expected_rows=wh.counts.get("clean"))


def value_counts(wh):
    return q.value_counts(wh.clean)


def dq_scorecard(wh):
    return q.dq_scorecard(wh.clean)


def constraint_checks(wh):
    return q.constraint_checks(_raw17(wh))


def referential_integrity(wh):
    return q.referential_integrity(wh)


def unique_key_checks(wh):
    return q.unique_key_checks(wh)


def raw_totals(wh):
    return q.raw_totals(_raw17(wh))


def raw_monthly(wh):
    return q.raw_monthly(_raw17(wh))


def table_sizes(wh: Warehouse) -> DataFrame:
    """DQ-23 rows and columns per star table (rows counted by a job)."""
    parts = []
    for name, t in wh.tables().items():
        parts.append(t.agg(big(F.count(F.lit(1))).alias("row_count"))
                     .select(F.lit(name).alias("table_name"), "row_count",
                             F.lit(len(t.columns)).cast("bigint").alias("column_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_summary(wh: Warehouse) -> DataFrame:
    """DQ-24 load-time control totals of the star, one row."""
    c = wh.dim_customer.agg(
        big(F.count(F.lit(1))).alias("customers"),
        big(F.sum(F.col("is_repeat_customer").cast("int"))).alias("repeat_customers"),
        pct(F.sum(F.col("is_repeat_customer").cast("int")), F.count(F.lit(1)), 1).alias("repeat_customer_pct"))
    p = wh.dim_product.agg(big(F.countDistinct("product_category")).alias("categories"))
    f = wh.with_dims(wh.fact, date=["full_date"]).agg(
        F.min("full_date").alias("first_order_date"), F.max("full_date").alias("last_order_date"),
        big(F.count(F.lit(1))).alias("orders"), dbl(F.sum("revenue")).alias("total_revenue"),
        dbl(F.sum("profit")).alias("total_profit"))
    return f.crossJoin(F.broadcast(c)).crossJoin(F.broadcast(p))  # three one-row aggregates


VIEWS = {
    "dq_profile": dq_profile,
    "dq_profile_by_file": dq_profile_by_file,
    "dq_numeric_summary": dq_numeric_summary,
    "dq_null_counts": dq_null_counts,
    "impute_median": impute_median,
    "impute_mode": impute_mode,
    "parse_dates": parse_dates,
    "coerce_types": coerce_types,
    "trim_strings": trim_strings,
    "dup_full_rows": dup_full_rows,
    "dup_keys": dup_keys,
    "dedup_keep_first": dedup_keep_first,
    "derive_date_parts": derive_date_parts,
    "check_revenue": check_revenue,
    "check_discounted_price": check_discounted_price,
    "outliers_iqr": outliers_iqr,
    "value_counts": value_counts,
    "dq_scorecard": dq_scorecard,
    "constraint_checks": constraint_checks,
    "referential_integrity": referential_integrity,
    "unique_key_checks": unique_key_checks,
    "raw_totals": raw_totals,
    "raw_monthly": raw_monthly,
    "table_sizes": table_sizes,
    "build_summary": build_summary,
}
