"""Sinks: cleaned set, star tables, idempotent replacement, insert-select,
view registration and JDBC (SNK-1 .. SNK-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.sources.tables import switch_table

CHECK_COLUMNS = ["revenue_check", "revenue_mismatch", "dp_check", "dp_mismatch"]


def write_clean(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """SNK-1 the cleaned set without the validation columns."""
    out = df.drop(*[c for c in CHECK_COLUMNS if c in df.columns])
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def write_warehouse(tables: dict, base: str, fmt: str = "parquet") -> dict:
    """SNK-2 the star as parquet or header CSV; the fact is partitioned by
    order year so a date filter prunes whole directories."""
    paths = {}
    for name, df in tables.items():
        p = f"{base.rstrip('/')}/{name}"
        if name == "fact_sales":
            # by date, so that a task writes into one or two years only
            w = (df.withColumn("order_year", (F.col("date_key") / 10000).cast("int"))
                   .repartitionByRange("date_key", "order_id").write.partitionBy("order_year"))
        else:
            w = df.write
        w.mode("overwrite").option("header", fmt == "csv").format(fmt).save(p)
        paths[name] = p
    return paths


def idempotent_replace(df: DataFrame, path: str, table: str) -> DataFrame:
    """SNK-3 re-runnable replacement of a catalog table: the rows are written
    into a fresh folder below ``path`` and the table moves there in one step.
    Running it twice leaves one copy; a write that fails leaves the old rows."""
    return switch_table(df, table, path)


def insert_select(spark: SparkSession, df: DataFrame, table: str, path: str, overwrite: bool = True) -> DataFrame:
    """SNK-4 load a catalog table from a query: created empty with the query's
    schema at ``path``, then filled with INSERT (OVERWRITE)."""
    if not spark.catalog.tableExists(table):
        df.limit(0).write.format("parquet").option("path", path).saveAsTable(table)
    df.write.insertInto(table, overwrite=overwrite)
    return spark.table(table)


def register_views(spark: SparkSession, wh) -> list:
    """SNK-5 the star tables and the 25 named views as temp views."""
    from tillstar.plans import customer, kpi, marketing
    names = []
    for name, df in wh.tables().items():
        df.createOrReplaceTempView(name)
        names.append(name)
    for mod in (kpi, customer, marketing):
        for name, view in mod.VIEWS.items():
            view(wh).createOrReplaceTempView(name)
            names.append(name)
    return names


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "overwrite") -> None:
    """SNK-6 replace a table in a relational database; executors write in
    parallel, one connection per partition."""
    df.write.jdbc(url=url, table=table, mode=mode, properties=properties or {})
