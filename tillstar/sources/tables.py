"""Catalog tables that a failed write leaves as they were.

``switch_table`` writes every version into a folder of its own and then moves
the table there by one change of its location: readers see the old rows or the
new ones, never a part.  ``partitioned_table`` is a table whose partitions are
replaced one by one (dynamic partition overwrite): an insert rewrites the
partitions of its rows and leaves the others alone."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def switch_table(df: DataFrame, table: str, base: str) -> DataFrame:
    """Replace ``table`` by ``df`` in one step; versions are folders below
    ``base``.  The version before stays for readers that have begun, the one
    before that goes."""
    spark = df.sparkSession
    path = f"{base.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
    try:
        df.write.mode("errorifexists").parquet(path)
    except Exception:
        delete_path(spark, path)
        raise
    if spark.catalog.tableExists(table):
        before = location(spark, table)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        before = None
        spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)
    spark.catalog.refreshTable(table)
    _drop_versions(spark, base, keep={path, before})
    return spark.table(table)


def _drop_versions(spark: SparkSession, base: str, keep: set) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = {k.rstrip("/").rsplit("/", 1)[-1] for k in keep if k}
    for status in files.listStatus(place):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in names:
            files.delete(status.getPath(), True)


def partitioned_table(spark: SparkSession, table: str, path: str, like: DataFrame, by: str) -> DataFrame:
    """The table, created empty where it does not exist; ``by`` comes last."""
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (path '{path}', "
                  f"partitionOverwriteMode 'dynamic') PARTITIONED BY ({by})")
    return spark.table(table)


def replace_partitions(df: DataFrame, table: str, by: str) -> None:
    """Rewrite the partitions of ``df``'s rows, and no other."""
    columns = [c for c in df.sparkSession.table(table).columns if c != by]
    df.select(*columns, by).write.insertInto(table, overwrite=True)


def drop_partitions(spark: SparkSession, table: str, by: str, values: list) -> None:
    base = location(spark, table)
    for v in values:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({by} = {v})")
        delete_path(spark, f"{base.rstrip('/')}/{by}={v}")


def drop_tables(spark: SparkSession, tables: list) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
