"""The pipeline's stages one after the other, and the queries' columns."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tillstar.llm import decontaminate, group_join, host_quality, mixing, queries
from tillstar.llm.common import shared_table

SF = "/root/testdata/sf0.001"


def test_stages_work_on_what_is_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = shared_table(stage(spark, before, SF), "test")
        ids = Counter(r.doc_id for r in after.collect())
        was = Counter(r.doc_id for r in before.collect())
        assert set(ids) <= set(was)
        if name == "quality_rules":
            assert ids == Counter(r.doc_id for r in host_quality.host_quality(before).filter("kept").collect())
        elif name == "near_duplicates":
            assert set(ids) == {r.component_id for r in group_join.near_duplicates(before).collect()}
            assert max(ids.values()) == 1
        elif name == "benchmark_leaks":
            leaks = decontaminate.find_leaks(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
            assert set(was) - set(ids) == {r.doc_id for r in leaks}
        elif name == "source_mix":
            assert ids == Counter({r.doc_id: r.copies for r in mixing.with_copies(before).collect() if r.copies})
        else:
            assert ids == was and after.columns == [*columns, "shard", "slot"]
            per = Counter(r.shard for r in after.collect())
            assert max(per.values()) - min(per.values()) <= 1
            break
        assert after.columns == columns
        before = after


def test_stages_on_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = shared_table(stage(spark, docs, SF), "test")
        assert docs.count() == 0


def test_queries_return_their_columns(spark):
    want = {
        "op1_language_id": ["doc_id", "held_out", "lang_pred", "score"],
        "op4_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
        "op7_mixing": ["doc_id", "size", "source_size", "target", "taken"],
        "op8_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op11_lexical_search": ["item_id", "rank", "doc_id", "score"],
        "op12_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
        "op13_html_extraction": ["page_id", "url", "text", "n_chars"],
    }
    for name, columns in want.items():
        assert queries.queries()[name](spark, SF).columns[:len(columns)] == columns
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_sql_agrees(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        got = queries.queries()[name](spark, SF)
        rows = con.execute(f"SELECT {', '.join(got.columns)} FROM ({sql})").fetchall()
        assert Counter(tuple(r) for r in got.collect()) == Counter(rows), name
