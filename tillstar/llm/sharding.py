"""Sharding by proportional stratified interleaving.

Rows are shuffled within each source by a seeded random key and ranked; a
row's fractional rank is (rank + 1/2) / rows of the source.  Sorted by that
fraction, the sources interleave in proportion everywhere, so cutting the
order into equal counts gives shards that each match the mixture.

Both rankings are distributed.  The keys are uniform, so a source is cut into
equal-width key ranges; the fractions are uniform by construction, so the
whole order is cut into equal-width fraction ranges.  A range is numbered by
itself and lifted by the count of the ranges before it.

Edge cases: null text has size 8 and checksum 0; a null source is a source of
its own and comes last; a null doc_id has the key of the empty string;
repeated rows get slots of their own; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import key_range, random_key, shared_table, small_side

SHARDS = 24
ROWS_PER_RANGE = 100_000
SEED = "shard-1"


def _numbered(rows: DataFrame, group: list, order: list, name: str) -> DataFrame:
    """Adds ``name``: the number (from 0) of the row in its group, in the order
    of the ranges ``r`` and of ``order`` inside them."""
    inside = Window.partitionBy(*group, "r").orderBy(*order)
    sums = rows.groupBy(*group, "r").count()
    before = Window.partitionBy(*group).orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(c).alias("o_" + c) for c in [*group, "r"]],
                          F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    same = F.col("r") == F.col("o_r")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col("o_" + c))
    return (rows.withColumn("inside", F.row_number().over(inside))
                .join(offsets, same)
                .withColumn(name, F.col("offset") + F.col("inside") - 1)
                .drop("offset", "inside", "r", *["o_" + c for c in [*group, "r"]]))


def assign_shards(docs: DataFrame, shards: int = SHARDS, seed: str = SEED,
                  rows_per_range: int = ROWS_PER_RANGE, keep: tuple = ()) -> DataFrame:
    """doc_id, source, size, text_crc32, shard, slot and the columns named in
    ``keep``: one row per row of ``docs``.  Shard counts differ by one at
    most; slots run from 0."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = shared_table(docs.select(
        F.col("doc_id"), F.col("source"), (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), random_key(seed, F.col("doc_id")).alias("key"),
        *keep), "shard-rows")
    per = narrow.groupBy("source").agg(F.count(F.lit(1)).alias("n")) \
                .withColumn("total", F.sum("n").over(Window.partitionBy())) \
                .withColumnRenamed("source", "p_source")
    rows = (narrow.join(per, F.col("source").eqNullSafe(F.col("p_source"))).drop("p_source")
                  .withColumn("r", key_range(F.col("key"), F.ceil(F.col("n") / rows_per_range))))
    tie = ["key", F.col("doc_id").asc_nulls_first(), "text_crc32", "size", *keep]
    ranked = _numbered(rows, ["source"], tie, "rank")
    ranked = ranked.withColumn("part", (2 * F.col("rank") + 1) / (2 * F.col("n")))
    ranges = F.ceil(F.col("total") / rows_per_range)
    ranked = ranked.withColumn("r", F.least(F.floor(F.col("part") * ranges), ranges - 1).cast("bigint"))
    # the ranking is read twice (range counts, rows): one table, not two runs
    ranked = shared_table(ranked, "shard-ranks")
    placed = _numbered(ranked, [], ["part", F.col("source").asc_nulls_last(), *tie], "place")
    # the first place p of shard s is the least p with p * shards >= s * total
    return placed.withColumn("shard", F.expr(f"(place * {shards}) div total")).select(
        "doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
        F.expr(f"place - (shard * total + {shards - 1}) div {shards}").alias("slot"), *keep)


def sharded_rows(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, all columns (but ones named shard or slot), with
    ``shard`` and ``slot``.

    A row's place (file and row number) tells equal rows apart, and only
    narrow rows are ranked; rows that do not come from files are written
    once."""
    columns = [c for c in docs.columns if c not in ("shard", "slot")]

    def placed(rows):
        return rows.select(F.struct(*columns).alias("_row"), "doc_id", "source", "text",
                           F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    try:
        rows = placed(docs)
        rows.schema
    except AnalysisException:       # no file below
        rows = placed(shared_table(docs.select(*columns), "shard-input"))
    shards = shared_table(assign_shards(rows, keep=("_file", "_at"), **how)
                          .select("_file", "_at", "shard", "slot"), "shard-places")
    return rows.select("_row", "_file", "_at").join(small_side(shards), ["_file", "_at"]).select(
        *[F.col("_row").getField(c).alias(c) for c in columns], "shard", "slot")
