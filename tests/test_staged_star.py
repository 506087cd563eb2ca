"""The star of a session is built when a report first asks for it."""

from pyspark.sql import functions as F

from tests.fixtures import make_raw
from tillstar.plans import load_reports, quality_reports, warehouse
from tillstar.plans.warehouse import build_warehouse, warehouse_for

SF = "/root/testdata/sf0.001"


def staged(spark):
    warehouse._CACHE.pop((spark.sparkContext.applicationId, SF), None)
    return warehouse_for(spark, SF)


def test_reports_on_raw_lines_build_no_star(spark, release_cache):
    wh = staged(spark)
    try:
        assert quality_reports.dq_profile_by_file(wh).count() == 17
        assert not {"clean", "fact", "counts"} & set(wh.__dict__)
        assert load_reports.second_load_partitions(wh).count() > 0
        assert "clean" in wh.__dict__ and not {"fact", "dim_customer", "counts"} & set(wh.__dict__)
    finally:
        wh.release()
        warehouse._CACHE.pop((spark.sparkContext.applicationId, SF), None)


def test_staged_star_equals_the_star_built_at_once(spark, release_cache):
    raw = make_raw(spark, [dict(), dict(customer_id=2), dict(customer_id=4), dict(product_id=3)])
    raw = raw.withColumn("customer_id", F.when(F.col("customer_id") != 4, F.col("customer_id")))
    late, whole = warehouse.StagedWarehouse(spark, raw), build_warehouse(spark, raw)
    rows = lambda df: sorted(map(str, df.select(*[c for c in df.columns if not c.startswith("_")]).collect()))
    assert late.quarantined.count() == whole.quarantined.count() == 1
    for name, df in whole.tables().items():
        assert rows(late.tables()[name]) == rows(df)
    clock = {"_build_phases"}
    assert {k: v for k, v in late.counts.items() if k not in clock} == {k: v for k, v in whole.counts.items() if k not in clock}


def exchanged(df):
    """(partitioning, columns) of the shuffles in the plan of ``df``."""
    out, todo = [], [df._jdf.queryExecution().executedPlan().initialPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            out.append((node.outputPartitioning().toString(), node.output().mkString(",")))
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return out


def without_broadcasts(spark, request):
    forced = {"spark.sql.autoBroadcastJoinThreshold": "-1", "tillstar.broadcast.maxRows": "0"}
    for k, v in forced.items():
        before = spark.conf.get(k, None)
        request.addfinalizer(lambda k=k, v=before: spark.conf.unset(k) if v is None else spark.conf.set(k, v))
        spark.conf.set(k, v)


def test_finished_rows_are_not_shuffled_for_the_first_line_of_an_order(spark, request, release_cache):
    without_broadcasts(spark, request)
    wh = staged(spark)
    warehouse._CACHE.pop((spark.sparkContext.applicationId, SF), None)
    for orders in (wh._orders, warehouse.clean_orders(wh.raw)):
        shuffles = exchanged(orders)
        assert any(p.startswith("hashpartitioning(l_orderkey") for p, _ in shuffles)
        assert not any("order_id" in p or "shipping_cost" in c or "profit" in c for p, c in shuffles)
    assert wh._orders.exceptAll(warehouse.clean_orders(wh.raw)).count() == 0
    assert wh._orders.count() == wh.raw.select("order_id").distinct().count()


def test_wide_orders_stay_where_they_are_while_keys_are_found(spark, request, release_cache):
    without_broadcasts(spark, request)
    raw = make_raw(spark, [dict(), dict(customer_id=2), dict(product_id=3)])
    clean = warehouse.clean_orders(raw)
    dims = {"dim_customer": clean.selectExpr("customer_id", "customer_id + 70 AS customer_key").distinct(),
            "dim_product": clean.selectExpr("product_id", "product_category", "product_id + 80 AS product_key").distinct(),
            "dim_country": clean.selectExpr("customer_country AS country_name", "1 AS country_key").distinct(),
            "dim_traffic_source": clean.selectExpr("traffic_source", "1 AS traffic_source_key").distinct(),
            "dim_payment_method": clean.selectExpr("payment_method", "1 AS payment_method_key").distinct()}
    counts = dict.fromkeys(dims, 9)
    fact = warehouse.build_fact(clean, dims, counts, spark, 3)
    assert not any("shipping_cost" in c and ("(customer_id" in p or "(product_id" in p) for p, c in exchanged(fact))
    found = {r.order_id: (r.sales_key, r.customer_key - 70, r.product_key - 80) for r in fact.collect()}
    assert found == {r.order_id: (i + 1, r.customer_id, r.product_id)
                     for i, r in enumerate(clean.orderBy("order_id").collect())} and len(found) == 3
