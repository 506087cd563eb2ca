"""Keep-first de-duplication on a business key (DQ-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.schemas import INGEST_SEQ


def dedup_keep_first(df: DataFrame, key: str = "order_id", order_cols: list | None = None) -> DataFrame:
    """Keep the first row per ``key``.

    "First" is the ingestion sequence when the frame carries one, else an
    explicit total order on every column -- never the arbitrary row that
    ``dropDuplicates`` would keep.  ``row_number() = 1`` is planned as a
    WindowGroupLimit: each map task keeps only its first row per key before
    the shuffle, so a key that repeats millions of times is reduced map-side.
    """
    if order_cols is None:
        order_cols = [INGEST_SEQ] if INGEST_SEQ in df.columns else sorted(c for c in df.columns if c != key)
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order_cols])
    return df.withColumn("_keep_rn", F.row_number().over(w)).filter(F.col("_keep_rn") == 1).drop("_keep_rn")
