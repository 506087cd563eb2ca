"""The corpus pipeline: quality rules, near-duplicate join, benchmark
decontamination, mixing and sharding.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage
before kept, and its decisions take effect: rejected documents go, one
document of each group of near duplicates stays, documents that repeat a
benchmark item go, the mix repeats or leaves documents by its targets, and
every document gets its shard and slot.  All but the last return the columns
of their input.

Edge cases: a document with a null id is judged by its own text only (it joins
no group of near duplicates); repeated rows of one document are one document
for the near-duplicate stage and stay once; an empty table stays empty; extra
columns pass through all stages, and the last one names its own ``shard`` and
``slot`` after dropping columns of these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import common, decontaminate, group_join, host_quality, mixing, sharding


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host-level quality rules keep."""
    return host_quality.kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group."""
    return group_join.first_of_group(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot."""
    return sharding.sharded_rows(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("benchmark_leaks", benchmark_leaks),
          ("source_mix", source_mix), ("shards", shards)]

#: The Jaccard components and SimHash windows have no SQL form; the stages are
#: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
