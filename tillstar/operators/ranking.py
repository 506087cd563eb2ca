"""Global ordered statistics without funnelling every row into one task.

``RANK() OVER (ORDER BY x)``, ``NTILE``, ``PERCENT_RANK`` and running sums
over a whole customer or product table need a *global* order.  A plain
``Window.orderBy`` (no PARTITION BY) moves all rows to a single task.  This
operator cuts the order into ranges of about ``tillstar.window.rowsPerRange``
rows:

1. only the sort keys, the grouping and the summed columns are ranked; a wide
   table is joined back on its unique key by the caller;
2. range-partitions the rows on the full sort order (measure + unique
   tie-break, so no single value can overload a range) and checkpoints the
   result to the shared checkpoint folder, freezing the partition of every
   row (range bounds come from sampling and must not change on recompute);
3. numbers rows inside each range with windows partitioned by that range
   (parallel, one task per range);
4. aggregates one row of statistics per range (count, sums, first and last
   sort value, distinct count) and turns them into offsets with a window over
   that small table;
5. adds the offsets back: global row_number, rank, dense_rank, ntile,
   percent_rank and running sums.  A tie group that straddles a range boundary
   is fixed by taking the minimum candidate rank of the (at most one per
   boundary) straddling values.

Groups, keys and tie-breaks may be null; every join is null-safe.  An input
of a single range needs no offsets: its range is numbered as it stands.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.session import conf_int, ensure_checkpoint_dir

ROWS_PER_RANGE_KEY = "tillstar.window.rowsPerRange"
ROWS_PER_RANGE = 1_000_000

_PID, _LRN, _LRK, _LDR = "_os_pid", "_os_lrn", "_os_lrk", "_os_ldr"


@dataclass
class OrderSpec:
    """Sort keys defining ties (``keys``) plus a unique tie-break suffix.

    Each key is ``(column, descending)``; nulls sort last in both directions.
    """
    keys: list
    tie_break: list = field(default_factory=list)

    def _exprs(self, items):
        out = []
        for name, desc in items:
            c = F.col(name)
            out.append(c.desc_nulls_last() if desc else c.asc_nulls_last())
        return out

    @property
    def rank_exprs(self):
        return self._exprs(self.keys)

    @property
    def full_exprs(self):
        return self._exprs(list(self.keys) + list(self.tie_break))

    @property
    def rank_cols(self):
        return [k for k, _ in self.keys]


def _ntile(rn: Column, n: Column, k: int) -> Column:
    """NTILE(k) from the global row number and row count (larger buckets first)."""
    q = F.floor(n / k).cast("bigint")
    r = (n - q * k).cast("bigint")
    big_rows = r * (q + 1)
    return F.when(rn <= big_rows, F.floor((rn - 1) / (q + 1)) + 1) \
            .otherwise(r + F.floor((rn - big_rows - 1) / F.greatest(q, F.lit(1))) + 1).cast("bigint")


def ordered_stats(df: DataFrame, order: OrderSpec, *, partition_by: list | None = None,
                  row_number: str | None = None, rank: str | None = None,
                  dense_rank: str | None = None, percent_rank: str | None = None,
                  ntiles: dict | None = None, running_sums: dict | None = None,
                  totals: dict | None = None, row_count: str | None = None,
                  expected_rows: int | None = None) -> DataFrame:
    """Add ordered statistics to ``df``, globally or per ``partition_by`` group.

    ``ntiles``: {out_col: k}; ``running_sums``: {out_col: value_col} (ROWS
    UNBOUNDED PRECEDING .. CURRENT ROW over the full order); ``totals``:
    {out_col: value_col} (SUM OVER the group); ``row_count``: COUNT(*) OVER
    the group.  ``expected_rows`` is the known row count (e.g. of a
    dimension); without it the rows are counted.
    """
    ntiles, running_sums, totals = ntiles or {}, running_sums or {}, totals or {}
    part = list(partition_by or [])
    per_range = conf_int(df.sparkSession, ROWS_PER_RANGE_KEY, ROWS_PER_RANGE)
    rows = df.count() if expected_rows is None else expected_rows
    ranges = max(1, -(-rows // per_range))
    args = (row_number, rank, dense_rank, percent_rank, ntiles, running_sums, totals, row_count)
    if ranges == 1:
        return _one_range(df, order, part, *args)
    return _many_ranges(df, order, part, *args, n_ranges=ranges)


def _one_range(df, order, part, row_number, rank, dense_rank, percent_rank, ntiles,
                 running_sums, totals, row_count):
    w_full = Window.partitionBy(*part).orderBy(*order.full_exprs)
    w_rank = Window.partitionBy(*part).orderBy(*order.rank_exprs)
    w_all = Window.partitionBy(*part)
    out = df
    if row_number:
        out = out.withColumn(row_number, F.row_number().over(w_full).cast("bigint"))
    if rank:
        out = out.withColumn(rank, F.rank().over(w_rank).cast("bigint"))
    if dense_rank:
        out = out.withColumn(dense_rank, F.dense_rank().over(w_rank).cast("bigint"))
    if percent_rank:
        out = out.withColumn(percent_rank, F.percent_rank().over(w_rank))
    for name, k in ntiles.items():
        out = out.withColumn(name, F.ntile(k).over(w_full).cast("bigint"))
    for name, col in running_sums.items():
        out = out.withColumn(name, F.sum(col).over(w_full.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    for name, col in totals.items():
        out = out.withColumn(name, F.sum(col).over(w_all))
    if row_count:
        out = out.withColumn(row_count, F.count(F.lit(1)).over(w_all).cast("bigint"))
    return out


def _and(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def _many_ranges(df, order, part, row_number, rank, dense_rank, percent_rank, ntiles,
                 running_sums, totals, row_count, n_ranges):
    ensure_checkpoint_dir(df.sparkSession)
    base_cols = df.columns
    part_sort = [F.col(c).asc_nulls_last() for c in part]

    # 1. freeze a range partitioning on (group, full unique order)
    ranged = (df.repartitionByRange(n_ranges, *part_sort, *order.full_exprs)
                .withColumn(_PID, F.spark_partition_id())
                .checkpoint(eager=True))
    # One partition per range id for the per-range windows: a range exchange
    # on the id satisfies their clustering (the default hash exchange on the
    # id would pile several ranges into one task).
    ranged = ranged.repartitionByRange(n_ranges, F.col(_PID))

    # 2. local numbering within each (range, group)
    grp = [_PID] + part
    w_full = Window.partitionBy(*grp).orderBy(*order.full_exprs)
    w_rank = Window.partitionBy(*grp).orderBy(*order.rank_exprs)
    need_rank = bool(rank or percent_rank)
    local = ranged.withColumn(_LRN, F.row_number().over(w_full))
    if need_rank:
        local = local.withColumn(_LRK, F.rank().over(w_rank))
    if dense_rank:
        local = local.withColumn(_LDR, F.dense_rank().over(w_rank))
    run_cols = {}
    for i, (name, col) in enumerate(running_sums.items()):
        run_cols[name] = (f"_os_run{i}", col)
        local = local.withColumn(f"_os_run{i}", F.sum(col).over(
            w_full.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    # 3. one row of statistics per (range, group): at most ranges + groups - 1
    rk = F.struct(*[F.col(c) for c in order.rank_cols])
    aggs = [F.count(F.lit(1)).alias("_os_cnt"),
            F.min_by(rk, F.col(_LRN)).alias("_os_head"),
            F.max_by(rk, F.col(_LRN)).alias("_os_tail")]
    if dense_rank:
        aggs.append(F.max(_LDR).alias("_os_dcnt"))
    sum_cols = {}
    for i, col in enumerate(sorted(set([c for _, c in run_cols.values()] + list(totals.values())))):
        sum_cols[col] = f"_os_ps{i}"
        aggs.append(F.sum(col).alias(f"_os_ps{i}"))
    stats = local.groupBy(*grp).agg(*aggs)
    sw = Window.partitionBy(*part).orderBy(_PID)
    w_prev = sw.rowsBetween(Window.unboundedPreceding, -1)
    w_upto = sw.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = Window.partitionBy(*part)
    same = F.coalesce(F.col("_os_head").eqNullSafe(F.lag("_os_tail").over(sw)), F.lit(False))
    stats = (stats.withColumn("_os_same", same)
                  .withColumn("_os_off", F.coalesce(F.sum("_os_cnt").over(w_prev), F.lit(0)))
                  .withColumn("_os_n", F.sum("_os_cnt").over(w_all)))
    if dense_rank:
        stats = stats.withColumn("_os_doff", F.coalesce(F.sum("_os_dcnt").over(w_prev), F.lit(0))
                                 - F.sum(F.col("_os_same").cast("int")).over(w_upto))
    for col, ps in sum_cols.items():
        stats = (stats.withColumn(ps + "_off", F.coalesce(F.sum(ps).over(w_prev), F.lit(0)))
                      .withColumn(ps + "_tot", F.sum(ps).over(w_all)))
    # one row per range (and group): written once, read by all that follows
    stats = stats.drop("_os_tail", "_os_cnt").checkpoint(eager=True)

    # 4. offsets back onto the rows
    offsets = stats.drop("_os_head", "_os_same").withColumnsRenamed({c: f"_os_j{i}" for i, c in enumerate(grp)})
    out = local.join(offsets, _and([F.col(c).eqNullSafe(F.col(f"_os_j{i}")) for i, c in enumerate(grp)]))
    rn = (F.col(_LRN) + F.col("_os_off")).cast("bigint")
    n = F.col("_os_n").cast("bigint")
    if need_rank:
        out = out.withColumn("_os_rank", (F.col(_LRK) + F.col("_os_off")).cast("bigint"))
        keys = part + order.rank_cols
        straddle = stats.filter("_os_same").select(
            *[F.col(c).alias(f"_os_h{i}") for i, c in enumerate(part)],
            *[F.col("_os_head")[c].alias(f"_os_h{len(part) + i}") for i, c in enumerate(order.rank_cols)])
        if straddle.limit(1).count() > 0:
            # at most one straddling tie group per range boundary: bounded
            cond = _and([F.col(c).eqNullSafe(F.col(f"_os_h{i}")) for i, c in enumerate(keys)])
            fix = (out.join(straddle, cond, "left_semi")
                      .groupBy(*keys).agg(F.min("_os_rank").alias("_os_fix")))
            fix = fix.select(*[F.col(c).alias(f"_os_f{i}") for i, c in enumerate(keys)], "_os_fix")
            cond2 = _and([F.col(c).eqNullSafe(F.col(f"_os_f{i}")) for i, c in enumerate(keys)])
            out = (out.join(fix, cond2, "left")
                      .withColumn("_os_rank", F.coalesce("_os_fix", "_os_rank")))
    res = out
    if row_number:
        res = res.withColumn(row_number, rn)
    if rank:
        res = res.withColumn(rank, F.col("_os_rank"))
    if dense_rank:
        res = res.withColumn(dense_rank, (F.col(_LDR) + F.col("_os_doff")).cast("bigint"))
    if percent_rank:
        res = res.withColumn(percent_rank,
                             F.when(n > 1, (F.col("_os_rank") - 1) / (n - 1)).otherwise(F.lit(0.0)))
    for name, k in ntiles.items():
        res = res.withColumn(name, _ntile(rn, n, k))
    for name, (tmp, col) in run_cols.items():
        res = res.withColumn(name, F.col(tmp) + F.col(sum_cols[col] + "_off"))
    for name, col in totals.items():
        res = res.withColumn(name, F.col(sum_cols[col] + "_tot"))
    if row_count:
        res = res.withColumn(row_count, n)
    new_cols = [c for c in [row_number, rank, dense_rank, percent_rank] if c] + list(ntiles) \
        + list(running_sums) + list(totals) + ([row_count] if row_count else [])
    return res.select(*base_cols, *new_cols)
