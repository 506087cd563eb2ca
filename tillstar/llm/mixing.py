"""Mixing sources to target weights.

Every document gets a random key from a hash of its id.  Within its source,
documents are sorted by that key: each source is cut into equal-width key
ranges of a bounded expected number of rows, sizes are summed per range, the
sums of the ranges before give each range its offset, and a running sum inside
the range completes the prefix sum of any document.  No source, however
large, is sorted in one task.  A source's budget is whole epochs plus a rest;
the prefix sums give the place where the rest is used up (the document that
the budget cuts through goes to the nearer side, so documents stay whole).

The cut is a point in key order, so it is applied to the documents by
comparing their own key with their source's cut: nothing is joined by id, and
the cuts, a row per source, go to the documents (by broadcast after a check of
their size), so no source meets in one task.  Rows of equal id, size and text
that the cut falls between are numbered in their partitions, with the counts
of the partitions before as offsets, and as many are taken as fit.

Edge cases: null text has size 0; a null doc_id has the key of the empty
string, and such rows go by size and text; a null source is a source of its own
and comes last; repeated rows count one by one, so the mix can take some of
them; of ties any may be taken, which gives the same rows; very long texts are
documents like any other, so a source comes as near its target as its longest
document allows; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import key_range, random_key, shared_table, small_side, word_count

# Weights by the position of the source's name in code point order, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
ROWS_PER_RANGE = 100_000
SEED = "mix-1"
# The order of a source's rows; equal in all of these are rows of one text.
ORDER = ("key", "doc_id", "size", "text_hash")


def _keyed(docs: DataFrame, seed: str, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"),
                       random_key(seed, F.col("doc_id")).alias("key"), F.xxhash64("text").alias("text_hash"), *more)


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """source, n, source_size, target, epochs, rest: one row per source.

    ``target`` fills up by weight: with sources in the order of
    ``most * size / weight``, the level at which the total is reached is the
    largest of the levels left after the sources before are full; a source
    gets ``weight * level``, ``most * size`` at most.  One row per source goes
    through the ordered windows."""
    per = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("most", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy((F.col("most") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) * F.lit(share)
              - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    per = per.withColumn("level", level)
    per = per.withColumn("target", F.least(F.col("most"), F.col("weight") * F.max("level").over(everything)))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return (per.withColumn("epochs", epochs.cast("bigint"))
               .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
               .select("source", "n", "source_size", "target", "epochs", "rest"))


def source_cuts(sized: DataFrame, rows_per_range: int = ROWS_PER_RANGE, **how) -> DataFrame:
    """The targets with ``cut``: the last row in order taken once more than
    ``epochs`` times, null if none is, and ``place``, its number among its equals."""
    targets = shared_table(source_targets(sized, **how).withColumnRenamed("source", "t_source"), "mix-targets")
    rows = sized.join(small_side(targets.select("t_source", "rest", F.ceil(F.col("n") / rows_per_range).alias("ranges"))),
                      F.col("source").eqNullSafe(F.col("t_source"))) \
                .select("source", *ORDER, "rest", key_range(F.col("key"), F.col("ranges")).alias("r"))
    sums = rows.groupBy("source", "r").agg(F.sum("size").alias("range_size"))
    offsets = sums.select(
        F.col("source").alias("o_source"), F.col("r").alias("o_r"),
        F.coalesce(F.sum("range_size").over(Window.partitionBy("source").orderBy("r")
                   .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    order = Window.partitionBy("source", "r").orderBy(
        "key", F.col("doc_id").asc_nulls_first(), "size", "text_hash")
    inside = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (rows.withColumn("upto", F.sum("size").over(inside))
                  .withColumn("place", F.row_number().over(order) - F.rank().over(order) + 1)
                  .join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("r") == F.col("o_r"))))
    middle = F.col("offset") + F.col("upto") - F.col("size") / 2
    last = (placed.filter((F.col("rest") > 0) & (middle <= F.col("rest")))
                  .groupBy("source").agg(F.max(F.struct(F.struct(*ORDER).alias("cut"), "place")).alias("last"))
                  .withColumnRenamed("source", "c_source"))
    return (targets.join(last, F.col("t_source").eqNullSafe(F.col("c_source")), "left")
                   .select("t_source", "source_size", "target", "epochs", "last.cut", "last.place"))


def _once_more(rows: DataFrame) -> DataFrame:
    """``extra``: 1 for the rows up to their source's cut, of the cut's equals
    for the first ``place``."""
    own = F.struct(*ORDER)
    split = rows.filter(own.eqNullSafe(F.col("cut"))).groupBy("t_source", "place").agg(F.count(F.lit(1)).alias("equals")) \
        .filter(F.col("equals") > F.col("place"))
    if not split.take(1):
        return rows.withColumn("extra", F.coalesce(own <= F.col("cut"), F.lit(False)).cast("bigint"))
    at_cut = own.eqNullSafe(F.col("cut"))
    others = rows.filter(~at_cut).withColumn("extra", F.coalesce(own < F.col("cut"), F.lit(False)).cast("bigint"))
    equals = rows.filter(at_cut).withColumn("part", F.spark_partition_id())
    per = equals.groupBy("t_source", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("t_source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("t_source").alias("p_source"), F.col("part").alias("p_part"),
                     F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    number = F.row_number().over(Window.partitionBy("t_source", "part").orderBy(F.lit(1)))
    numbered = equals.withColumn("number", number).join(
        F.broadcast(per), F.col("t_source").eqNullSafe(F.col("p_source")) & (F.col("part") == F.col("p_part")))
    return others.unionByName(numbered.withColumn("extra", (F.col("first") + F.col("number") <= F.col("place")).cast("bigint"))
                              .drop("part", "p_source", "p_part", "first", "number"))


def with_copies(docs: DataFrame, seed: str = SEED, keep: tuple = (), **how) -> DataFrame:
    """doc_id, size, source_size, target and ``copies`` (times the mix takes
    the document), with the columns named in ``keep``."""
    sized = shared_table(_keyed(docs, seed), "mix-sizes")
    cuts = shared_table(source_cuts(sized, **how), "mix-cuts")
    if keep:
        sized = _keyed(docs, seed, *keep)
    rows = sized.join(small_side(cuts), F.col("source").eqNullSafe(F.col("t_source")))
    return (_once_more(rows).withColumn("copies", F.col("epochs") + F.col("extra"))
                            .withColumn("taken", F.col("size") * F.col("copies")))


def mix(docs: DataFrame, seed: str = SEED, **how) -> DataFrame:
    """The mixed rows: every document as often as the mix takes it, with the
    columns of ``docs``."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_mix_row")
    rows = with_copies(docs.select("doc_id", "text", "source", row), seed, keep=("_mix_row",), **how)
    return (rows.filter("copies > 0")
                .select("_mix_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
                .select(*[F.col("_mix_row").getField(c).alias(c) for c in docs.columns]))
