"""Profiles kept per file: new files only are read, and the merged profile is
that of all rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstar.operators import quality as q
from tillstar.operators.profile import ProfileStore, dtypes_of
from tillstar.session import scratch_path

SCHEMA = ("order_id bigint, a int, b decimal(10,2), c decimal(30,4), d double, e string, f date, g boolean, h timestamp, "
          "i string, file string")
COLS = list("abcdefghi") + ["order_id"]


def rows(lo, hi):
    return [(k, k % 5 or None, Decimal(k % 7), Decimal(k % 3), k / 4 if k % 2 else None, f"v{k % 11}", dt.date(2023, 1, 1 + k % 9),
             k % 2 == 0, dt.datetime(2023, 1, 1, k % 6), None, "x") for k in range(lo, hi)]


@pytest.fixture
def lake(spark):
    place = scratch_path(spark, "profile-lake")

    def add(lo, hi):
        spark.createDataFrame(rows(lo, hi), SCHEMA).coalesce(1).write.mode("append").parquet(place)
        return spark.read.parquet(place).inputFiles()
    return add


def test_profile_after_a_new_file_reads_that_file_only(spark, lake):
    store, asked = ProfileStore(spark, scratch_path(spark, "profile-store")), []

    def read(files):
        asked.append(list(files))
        return spark.read.schema(SCHEMA).parquet(*files).drop("file")

    first = lake(50, 90)
    store.update(first, read, COLS)
    files = lake(0, 60)
    state, fresh = store.update(files, read, COLS)
    assert asked == [first, fresh] and len(fresh) == 1 and fresh[0] not in first
    every = spark.read.schema(SCHEMA).parquet(*files).drop("file")
    report = state.report(dtypes_of(every, COLS))
    assert sorted(map(tuple, report.collect()), key=str) == sorted(map(tuple, q.dq_profile(every, COLS).collect()), key=str)
    by = {r["column_name"]: r for r in report.collect()}
    assert (by["a"]["distinct_count"], by["a"]["null_count"], by["a"]["sample_value"]) == (4, 20, "1")
    assert by["order_id"]["distinct_count"] == 90 and by["i"]["distinct_count"] == 0 and by["i"]["sample_value"] is None
    # nothing new: nothing is read; a file that has gone is left out
    again, fresh = store.update(files, read, COLS)
    assert fresh == [] and len(asked) == 2
    left, _ = store.update(first, read, COLS)
    assert {r["column_name"]: r["non_null"] for r in left.report(dtypes_of(every, COLS)).collect()}["order_id"] == 40


def test_lot_that_failed_is_made_up(spark, lake):
    store = ProfileStore(spark, scratch_path(spark, "profile-store"))
    read = lambda files: spark.read.schema(SCHEMA).parquet(*files).drop("file")
    files = lake(0, 30)
    # values without counts: a run that was lost
    spark.createDataFrame([(files[0], "a", 999, None)], "file string, column_name string, num bigint, text string").write.parquet(
        f"{store.base}/values/lot=lost")
    state, fresh = store.update(files, read, COLS)
    assert fresh == files
    got = {r["column_name"]: r["distinct_count"] for r in state.report(dtypes_of(read(files), COLS)).collect()}
    assert got["a"] == 4 and got["order_id"] == 30


def test_stored_values_hold_no_paths(spark, lake):
    """A path in every distinct value would outweigh the value itself."""
    store = ProfileStore(spark, scratch_path(spark, "profile-store"))
    files = lake(0, 30)
    store.update(files, lambda fs: spark.read.schema(SCHEMA).parquet(*fs).drop("file"), COLS)
    named = [r["file"] for r in spark.read.parquet(f"{store.base}/values").select("file").distinct().collect()]
    assert len(named) == len(files) and all(len(n) < 24 and "/" not in n for n in named)


def test_empty_table(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    got = q.dq_profile(nothing, COLS).collect()
    assert len(got) == len(COLS) and all(r["non_null"] == 0 and r["distinct_count"] == 0 and r["null_pct"] is None for r in got)
    state, fresh = ProfileStore(spark, scratch_path(spark, "profile-store")).update([], lambda files: nothing, COLS)
    assert fresh == [] and len(state.report(dtypes_of(nothing, COLS)).collect()) == len(COLS)
    assert nothing.select(F.count("*")).first()[0] == 0
