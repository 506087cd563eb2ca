"""The range-partitioned global ordering equals the plain window."""

import random

import pytest

from tillstar.operators.ranking import OrderSpec, ordered_stats


@pytest.mark.parametrize("part", [[], ["g"]])
@pytest.mark.parametrize("desc", [False, True])
def test_distributed_equals_plain(spark, part, desc):
    rnd = random.Random(7)
    rows = [(i, rnd.choice(["a", "b", None]), rnd.randint(0, 40) if rnd.random() > 0.05 else None, rnd.randint(1, 9))
            for i in range(3001)]
    df = spark.createDataFrame(rows, "id long, g string, v long, w long")
    spec = OrderSpec(keys=[("v", desc)], tie_break=[("id", False)])
    kw = dict(partition_by=part, row_number="rn", rank="rk", dense_rank="dr", percent_rank="pr",
              ntiles={"n5": 5, "n4": 4}, running_sums={"rs": "w"}, totals={"tot": "w"}, row_count="cnt")
    plain = ordered_stats(df, spec, expected_rows=1, **kw)
    spark.conf.set("tillstar.window.rowsPerRange", "400")
    try:
        dist = ordered_stats(df, spec, expected_rows=3001, **kw)   # 8 ranges of ~400 rows
    finally:
        spark.conf.unset("tillstar.window.rowsPerRange")
    cols = plain.columns
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r if not isinstance(x, str)) + (r["g"] or "",)
    got = dist.select(cols).collect()
    assert len(got) == 3001
    assert sorted(plain.select(cols).collect(), key=key) == sorted(got, key=key)
