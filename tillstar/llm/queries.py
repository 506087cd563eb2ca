"""The thin queries ``opN_<name>`` over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import (compact_windows, decontaminate, group_join, host_quality, html_extraction, langid,
                          lexical_search, licenses, mixing, sharding, toxicity, warc, whitening)
from tillstar.llm.common import shared_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_remainder(column: str, m: int):
    """crc32 of the id as text, modulo m: the fold of a document."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % m


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows not held out."""
    docs = documents(spark, sf_dir)
    model = langid.train(docs.filter(id_remainder("doc_id", 3) != 1))
    return langid.predict(docs, model).select(
        "doc_id", F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and the host-level verdict for every document."""
    return host_quality.host_quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "host_flagged")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of near duplicates for every document."""
    return group_join.near_duplicates(documents(spark, sf_dir))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives all pages and reads every record back through the index."""
    folder = shared_path(spark, "warc")
    lines, directory = warc.archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return warc.read_back(lines.select("key"), directory, folder)


def op5_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents share."""
    return compact_windows.repeated_passages(documents(spark, sf_dir))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents repeat."""
    return decontaminate.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.with_copies(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; counts at most one apart."""
    return sharding.assign_shards(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels not held out."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(id_remainder("doc_id", 5) != 0)
    return toxicity.score(docs, toxicity.train(docs, labels)).select(
        "doc_id", F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document."""
    return licenses.scan_licenses(documents(spark, sf_dir))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first whitening components."""
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).select(
        "vec_id", "component", "n", F.col("deviation").try_cast("bigint").alias("deviation"), "whitened", "explained",
        "identity_error", F.col("deviation").alias("deviation_exact"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extraction.main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_language_id, op2_host_quality, op3_ngram_jaccard_join, op4_warc, op5_compact_windows, op6_decontamination,
        op7_mixing, op8_sharding, op9_toxicity, op10_license_scan, op11_lexical_search,
        op12_whitening, op13_html_extraction)}


def oracle_sql() -> dict:
    from tillstar.llm import sql
    return {"op2_host_quality": sql.HOST_QUALITY, "op4_warc": sql.WARC, "op7_mixing": sql.MIXING,
            "op11_lexical_search": sql.LEXICAL_SEARCH}
