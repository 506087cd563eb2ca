"""File-stream ingestion of raw sales reproduces the batch raw table."""

import os
import tempfile

from tests.fixtures import make_raw
from tillstar.streaming.ingest import start_raw_ingest


def test_stream_ingest_available_now(spark):
    base = tempfile.mkdtemp(prefix="tillstar-stream-")
    src, tgt, ck = (os.path.join(base, x) for x in ("landing", "raw", "ckpt"))
    raw = make_raw(spark, [dict(customer_id=i % 3 + 1, rating=None if i % 4 == 0 else "3.5") for i in range(20)])
    raw.repartition(3).write.option("header", True).csv(src)
    start_raw_ingest(spark, src, tgt, ck).awaitTermination()
    got = spark.read.parquet(tgt)
    assert got.count() == 20
    assert got.filter("rating IS NULL").count() == 5
    assert {r._source for r in got.select("_source").distinct().collect()} == {"sales_export"}
