"""File order, bad lines, missing keys and the exactness of quantiles."""

from __future__ import annotations

from decimal import Decimal

import pytest

from tests.fixtures import make_raw
from tillstar.operators import quality as q
from tillstar.operators.dedup import dedup_keep_first
from tillstar.plans.warehouse import build_warehouse
from tillstar.schemas import RAW_COLUMNS
from tillstar.sources import readers


def _line(order_id, price, country="USA"):
    return f"{order_id},2023-05-06,7,8,Toys,{price},0,1,{country},Email,PayPal,0,4.5,0,{price},{price},{price}"


def test_csv_keeps_file_order_and_bad_lines(spark, tmp_path):
    path = tmp_path / "sales.csv"
    lines = [",".join(RAW_COLUMNS), _line(1, "90.00"), "3,not-a-date,zz", _line(1, "10.00"), _line(2, "5.00"), _line(2, "4.00")]
    path.write_text("\n".join(lines) + "\n")
    rows = readers.read_sales_csv(spark, str(path))
    first = {r.order_id: r.product_price for r in dedup_keep_first(rows).collect()}
    assert first == {1: Decimal("90.00"), 2: Decimal("5.00")}
    assert [r[0] for r in readers.bad_lines(spark, str(path)).collect()] == ["3,not-a-date,zz"]
    assert rows.count() == 4


def test_rows_without_a_key_are_quarantined(spark, release_cache):
    raw = make_raw(spark, [dict(), dict()])
    from pyspark.sql import functions as F
    raw = raw.unionByName(raw.limit(1).withColumn("order_id", F.lit(3).cast("bigint"))
                          .withColumn("customer_country", F.lit(None).cast("string")))
    wh = build_warehouse(spark, raw)
    assert wh.fact.count() == 2 and wh.counts["quarantined"] == 1
    bad = wh.quarantined.collect()
    assert [(r.order_id, r.missing) for r in bad] == [(3, "customer_country")]
    assert all(r.country_name is not None for r in wh.dim_country.collect())


@pytest.mark.parametrize("kind, values, median", [
    ("bigint", [10 ** 17, 10 ** 17 + 2, 10 ** 17 + 4], 1e17 + 2),
    ("double", [0.00001, 0.00003, 0.00007], 0.00003),
    ("decimal(38,10)", [Decimal("0.0000000001"), Decimal("2"), Decimal("1e20")], 2.0),
])
def test_quantiles_keep_large_and_small_values(spark, kind, values, median):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    assert q.exact_quantiles(df, ["v"], [0.5]).first()["value"] == pytest.approx(median, rel=1e-12)


def test_empty_input_has_an_empty_calendar(spark, release_cache):
    wh = build_warehouse(spark, make_raw(spark, [dict()]).limit(0))
    assert wh.dim_date.count() == 0 and wh.fact.count() == 0
