"""Readers: CSV exports with explicit schemas, the written warehouse, and
the typed raw table with defaults and audit columns (SRC-1 .. SRC-5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.schemas import DEFAULT_SOURCE, INGEST_SEQ, RAW_COLUMNS, RAW_DEFAULTS, RAW_SALES, STAR_SCHEMAS

STAR_TABLES = list(STAR_SCHEMAS)


CORRUPT = "_corrupt_record"


def read_sales_lines(spark: SparkSession, path: str, schema: T.StructType = RAW_SALES) -> DataFrame:
    """Every line of the header CSV, with the ingestion sequence (file, block
    of the file, place in the block: the order of the file) and, for a line
    that does not fit the schema, its text in ``_corrupt_record``."""
    fields = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    # with pruned columns the parser would accept lines that it has not read in full
    lines = (spark.read.schema(fields).option("header", True).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path))
    place = F.struct("_metadata.file_path", "_metadata.file_block_start",
                     F.monotonically_increasing_id().alias("line"))
    return lines.select(*schema.fieldNames(), CORRUPT, place.alias(INGEST_SEQ))


def _lines_where(spark: SparkSession, path: str, schema: T.StructType, holds: Column) -> DataFrame:
    # Spark refuses a query that reads nothing but the text of bad lines (a
    # count), so the condition also reads the first column, of any value.
    read = F.length(F.concat_ws("", F.col(schema.fieldNames()[0]))) >= 0
    return read_sales_lines(spark, path, schema).filter(holds & read)


def read_sales_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SALES) -> DataFrame:
    """SRC-1 header CSV of raw sales, never schema-inferred, in file order.
    Lines that do not fit are left to ``bad_lines``.  Pass ``RAW_SALES_TEXT``
    to read everything as text for the coercion step."""
    return _lines_where(spark, path, schema, F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_lines(spark: SparkSession, path: str, schema: T.StructType = RAW_SALES) -> DataFrame:
    """The lines that ``read_sales_csv`` leaves out, as text."""
    return _lines_where(spark, path, schema, F.col(CORRUPT).isNotNull()).select(CORRUPT, INGEST_SEQ)


def clean_schema(extra_date_parts: bool = False) -> T.StructType:
    fields = list(RAW_SALES.fields)
    if extra_date_parts:
        fields += [T.StructField("order_year", T.IntegerType()), T.StructField("order_month", T.IntegerType()),
                   T.StructField("order_quarter", T.IntegerType()), T.StructField("order_dow", T.StringType())]
    return T.StructType(fields)


def read_clean(spark: SparkSession, path: str, fmt: str = "csv", with_date_parts: bool = False) -> DataFrame:
    """SRC-2 the cleaned set, order_date typed as DATE."""
    schema = clean_schema(with_date_parts)
    if fmt == "csv":
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.read.schema(schema).parquet(path)


def load_warehouse(spark: SparkSession, base: str, fmt: str = "parquet") -> dict:
    """SRC-3 the seven star tables written by ``write_warehouse``, as parquet
    or header CSV, each with its stated schema."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return {t: reader.schema(STAR_SCHEMAS[t]).format(fmt).load(f"{base.rstrip('/')}/{t}") for t in STAR_TABLES}


def raw_schema(df: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """SRC-4 raw table layout: the 17 typed columns with their defaults, plus
    ``_ingested_at`` (load time) and ``_source``."""
    cols = []
    for f in RAW_SALES.fields:
        c = F.col(f.name).cast(f.dataType)
        if f.name in RAW_DEFAULTS:
            c = F.coalesce(c, F.lit(RAW_DEFAULTS[f.name]).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols, F.current_timestamp().alias("_ingested_at"), F.lit(source).alias("_source"))


def raw_columns(df: DataFrame) -> DataFrame:
    return df.select(*RAW_COLUMNS)
