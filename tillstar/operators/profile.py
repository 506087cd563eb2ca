"""Column profiles as mergeable states, kept per input file.

The state of some rows is one row per column (rows, non-null values, the value
of the earliest row) and the distinct values per column, in their own type:
numbers, decimals and dates as 64-bit whole numbers, the rest as text.  States
of parts merge: counts add up, the earliest sample stays, distinct values are
united.  ``ProfileStore`` keeps the states of every input file, so a profile
after new files arrive reads the new files only."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions.metrics import big, pct
from tillstar.schemas import INGEST_SEQ

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


def _as_number(name: str, t: T.DataType) -> str | None:
    """SQL text of the column's value as a whole number; None if it has none."""
    if isinstance(t, WHOLE):
        return f"CAST(`{name}` AS BIGINT)"
    if isinstance(t, T.DecimalType) and t.precision <= 18:
        return f"CAST(`{name}` * CAST({10 ** t.scale} AS DECIMAL({t.scale + 1},0)) AS BIGINT)"
    if isinstance(t, T.DateType):
        return f"CAST(unix_date(`{name}`) AS BIGINT)"
    if isinstance(t, T.TimestampType):
        return f"unix_micros(`{name}`)"
    return None


def _order(df: DataFrame) -> Column:
    cols = [c for c in ["order_id", INGEST_SEQ] if c in df.columns]
    return F.struct(*cols) if cols else F.struct(F.lit(0).alias("none"))


@dataclass
class Profile:
    """``counts`` (column_name, rows, non_null, place, sample_value) and
    ``values`` (column_name, num, text), distinct; both apart for each file
    where the state was made so."""

    counts: DataFrame
    values: DataFrame

    def merge(self) -> "Profile":
        """One state of all files."""
        counts = self.counts.groupBy("column_name").agg(
            F.sum("rows").alias("rows"), F.sum("non_null").alias("non_null"), F.min("place").alias("place"),
            F.min_by("sample_value", "place").alias("sample_value"))
        return Profile(counts, self.values.select("column_name", "num", "text").distinct())

    def report(self, dtypes: dict) -> DataFrame:
        """DQ-1: a row per column."""
        distinct = self.values.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count"))
        types = self.counts.sparkSession.createDataFrame(list(dtypes.items()), "column_name string, dtype string")
        nulls = F.col("rows") - F.col("non_null")
        return self.counts.join(F.broadcast(types), "column_name").join(distinct, "column_name", "left").select(
            "column_name", "dtype", big("non_null").alias("non_null"), big(nulls).alias("null_count"),
            pct(nulls, F.col("rows")).alias("null_pct"), big(F.coalesce("distinct_count", F.lit(0))).alias("distinct_count"),
            "sample_value")


def dtypes_of(df: DataFrame, cols: list) -> dict:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name in cols}


def profile(df: DataFrame, cols: list, by: tuple = ()) -> Profile:
    """State of all rows, apart for each ``by``: one wide aggregate for the
    counts and samples, one (column, value) aggregate, combined map-side, for
    the distinct values."""
    place, keys = _order(df), "".join(f"{k}, " for k in by)
    wide = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"nn_{c}") for c in cols],
        *[F.min(F.when(F.col(f"`{c}`").isNotNull(), F.struct(place.alias("place"), F.col(f"`{c}`").cast("string").alias("v"))))
          .alias(f"sm_{c}") for c in cols])
    each = ", ".join(f"'{c}', _rows, `nn_{c}`, `sm_{c}`.place, `sm_{c}`.v" for c in cols)
    counts = wide.select(*by, F.expr(f"stack({len(cols)}, {each}) AS (column_name, rows, non_null, place, sample_value)"))
    kinds = {f.name: _as_number(f.name, f.dataType) for f in df.schema.fields}
    each = ", ".join(f"'{c}', {kinds[c]}, CAST(NULL AS STRING)" if kinds[c] else f"'{c}', CAST(NULL AS BIGINT), CAST(`{c}` AS STRING)"
                     for c in cols)
    values = df.select(*by, F.expr(f"stack({len(cols)}, {each}) AS (column_name, num, text)")).filter(
        "num IS NOT NULL OR text IS NOT NULL").distinct()
    return Profile(counts, values)


class ProfileStore:
    """States per input file below ``base``, written in lots.

    A lot counts once its ``counts`` are written, which is its last step, so a
    run that fails is made up by the next one.  Files are known by their path:
    a file does not change once it is there."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _read(self, kind: str) -> DataFrame | None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{kind}")
        there = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)
        return self.spark.read.parquet(f"{self.base}/{kind}") if there else None

    def update(self, files: list, read, cols: list) -> tuple[Profile, list]:
        """The profile of the files, and those read for it: the ones without a
        state.  ``read`` makes a DataFrame of a list of files.  States of files
        that are no longer listed are not used."""
        files = [re.sub("^file:/+", "file:///", f) for f in files]
        known = self._read("counts")
        seen = set() if known is None else {r["file"] for r in known.select("file").distinct().collect()}
        fresh = sorted(set(files) - seen)
        if fresh:
            rows = read(fresh)
            # one way to write a local path
            path = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///")
            lot = uuid.uuid4().hex[:12]
            # a short code stands for the path in every distinct value
            codes = F.broadcast(self.spark.createDataFrame(
                [(f, f"{lot}-{k}") for k, f in enumerate(fresh)], "file string, file_code string"))
            state = profile(rows.withColumn("file", path).join(codes, "file"), cols, by=("file_code",))
            state.values.withColumnRenamed("file_code", "file").write.parquet(f"{self.base}/values/lot={lot}")
            state.counts.join(codes, "file_code").write.parquet(f"{self.base}/counts/lot={lot}")
        counts = self._read("counts")
        if counts is None:
            return profile(read([]), cols), []
        listed = F.broadcast(self.spark.createDataFrame([(f,) for f in sorted(set(files))], "file string"))
        counts = counts.join(listed, "file", "left_semi")
        # values of a lot that has no counts belong to a run that failed
        lots = [r["lot"] for r in counts.select("lot").distinct().collect()]
        known = F.broadcast(counts.select(F.col("file_code").alias("file")).distinct())
        values = self._read("values").filter(F.col("lot").isin(lots)).join(known, "file", "left_semi")
        return Profile(counts, values).merge(), fresh
