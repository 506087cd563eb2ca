"""The cleaning operators on faulty lines.

The test tables are clean, so these reports first spoil the staged raw lines
by a fixed rule on order and line number (padding, missing and unreadable
values, broken formulas), as text like a CSV export, and then run the cleaning
operators and the whole cleaning job on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.metrics import big
from tillstar.operators import quality as q
from tillstar.plans.quality_reports import normalized
from tillstar.plans.warehouse import Warehouse, load_audit
from tillstar.schemas import INGEST_SEQ, RAW_COLUMNS
from tillstar.session import scratch_path
from tillstar.sources import sinks


def _every(k: int) -> Column:
    """True for one line in about ``k``."""
    return (F.col("order_id") * 7 + F.col(INGEST_SEQ)["l_linenumber"]) % k == 0


def spoiled_lines(wh: Warehouse) -> DataFrame:
    """Raw lines as text with faults, and their place of arrival."""
    raw = wh.raw_lines().select(*RAW_COLUMNS, INGEST_SEQ)
    spoiled = raw.withColumns({
        "revenue": F.when(_every(31), F.col("revenue") + 1).otherwise(F.col("revenue")).cast("decimal(12,2)"),
        "discounted_price": F.when(_every(37), F.col("discounted_price") + 5).otherwise(F.col("discounted_price"))
                             .cast("decimal(10,2)"),
        "rating": F.when(~_every(29), F.col("rating")),
    })
    text = {c: F.col(c).cast("string") for c in RAW_COLUMNS}
    text["customer_country"] = F.when(_every(41), None).when(_every(13), F.concat(F.lit("  "), "customer_country", F.lit(" "))) \
        .otherwise(F.col("customer_country"))
    text["traffic_source"] = F.when(~_every(17), F.col("traffic_source"))
    text["quantity"] = F.when(_every(19), "n/a").otherwise(F.col("quantity").cast("string"))
    text["order_date"] = F.when(_every(23), "2023-13-45").otherwise(F.col("order_date").cast("string"))
    return spoiled.select(*[text[c].alias(c) for c in RAW_COLUMNS], INGEST_SEQ)


def _line(df: DataFrame, *cols: str) -> DataFrame:
    return normalized(df.select(F.col("order_id").cast("bigint").alias("order_id"),
                                F.col(INGEST_SEQ)["l_linenumber"].cast("bigint").alias("line_number"), *cols))


def dirty_parse_dates(wh: Warehouse) -> DataFrame:
    """DQ-6 on lines with impossible dates."""
    return _line(q.parse_dates(spoiled_lines(wh)), "order_date")


def dirty_coerce_types(wh: Warehouse) -> DataFrame:
    """DQ-7 on lines with unreadable numbers and dates."""
    return _line(q.coerce_types(spoiled_lines(wh)), "order_date", "quantity", "rating", "revenue")


def dirty_trim_strings(wh: Warehouse) -> DataFrame:
    """DQ-8 on padded names."""
    return _line(q.trim_strings(spoiled_lines(wh)), "customer_country", "traffic_source")


def dirty_impute_median(wh: Warehouse) -> DataFrame:
    """DQ-4 on missing quantities and ratings."""
    return _line(q.impute_median(q.coerce_types(spoiled_lines(wh)), ["quantity", "rating"]), "quantity", "rating")


def dirty_impute_mode(wh: Warehouse) -> DataFrame:
    """DQ-5 on missing names."""
    return _line(q.impute_mode(q.trim_strings(spoiled_lines(wh)), ["customer_country", "traffic_source"]),
                 "customer_country", "traffic_source")


def dirty_checks(wh: Warehouse) -> DataFrame:
    """DQ-13 and DQ-14 on lines with broken formulas."""
    typed = q.coerce_types(spoiled_lines(wh))
    return q.check_revenue(typed).join(q.check_discounted_price(typed), "rows_checked")


def _cleaned(wh: Warehouse, impute: bool) -> DataFrame:
    return q.clean_pipeline(spoiled_lines(wh), impute=impute)


def clean_pipeline(wh: Warehouse) -> DataFrame:
    """The whole cleaning job: coerce, trim, keep the first line of an order,
    impute, check the formulas, and write without the check columns."""
    checked = q.flag_checks(_cleaned(wh, impute=True)).drop(INGEST_SEQ)
    path = sinks.write_clean(checked, scratch_path(wh.spark, "cleaned"))
    return normalized(wh.spark.read.schema(checked.drop(*sinks.CHECK_COLUMNS).schema).parquet(path))


def dirty_load_audit(wh: Warehouse) -> DataFrame:
    """Orders that could be loaded and orders quarantined, by what they lack."""
    return load_audit(_cleaned(wh, impute=False)).withColumn("row_count", big("row_count"))


VIEWS = {f.__name__: f for f in (dirty_parse_dates, dirty_coerce_types, dirty_trim_strings, dirty_impute_median,
                                 dirty_impute_mode, dirty_checks, clean_pipeline, dirty_load_audit)}
