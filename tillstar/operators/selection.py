"""Order statistics by histogram refinement.

The value at a position of a column's order is found without ordering the
column: one pass counts the values by ``BUCKETS`` equal ranges between the
least and the highest one, the next pass counts again inside the ranges that
hold a wanted position, until a range's least value is the wanted one.  Every
pass is a map-side combined count, whose result has at most ``BUCKETS`` rows
for each wanted position; a pass narrows a range by that factor, so whole
numbers of 64 bits take seven passes and prices two or three.  All columns and
positions go through the passes together."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# rows of (group, value) come back per range and pass
BUCKETS = 1024


@dataclass
class _Range:
    group: str
    lo: object
    hi: object
    before: int       # values of the group below lo
    wanted: list


def _share(value: Column, lo: Column, hi: Column, wide: Column, kind: str) -> Column:
    """Place of a value between lo and hi, from 0 to 1, never falling."""
    d = lambda c: c.cast("double")
    if kind == "double":              # of a wide span by halves, so that it stays finite
        return F.when(hi <= lo, F.lit(0.0)).when(wide, (value / 2 - lo / 2) / (hi / 2 - lo / 2)).otherwise(
            (value - lo) / (hi - lo))
    if kind != "bigint":
        return d(value - lo) / d(hi - lo)
    return F.when(wide, (d(value) - d(lo)) / (d(hi) - d(lo))).otherwise(d(value - lo) / d(hi - lo))


def _bucket(kind: str, buckets: int) -> Column:
    at = F.least(F.floor(_share(F.col("value"), F.col("lo"), F.col("hi"), F.col("wide"), kind) * buckets), F.lit(buckets - 1))
    if kind == "double":              # infinite values stand in ranges of their own
        inf = F.lit(float("inf"))
        at = F.when(F.col("value") == -inf, -1).when(F.col("value") == inf, buckets).otherwise(at)
    return at.cast("int")


def select_positions(rows: DataFrame, wanted: dict, kind: str, buckets: int = BUCKETS) -> dict:
    """{group: {position: (value, values below it)}} for rows (group, value).

    ``wanted`` is {group: positions}, from 1, or a function of {group: number
    of values}; positions beyond the values are left out.  ``kind`` is the
    values' type: bigint, double or a decimal; nulls and NaN hold no place."""
    rows = rows.filter(F.col("value").isNotNull())
    if kind == "double":
        rows = rows.filter(~F.isnan("value"))
    ends = {r["group"]: r for r in rows.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()}
    asked = wanted({g: r["n"] for g, r in ends.items()}) if callable(wanted) else wanted
    found = {g: {} for g in asked}
    open_ = []

    def settle(r: _Range):
        """Positions that fall on the range's first value are found."""
        r.wanted = sorted(set(r.wanted))
        if r.lo == r.hi:
            found[r.group].update({p: (r.lo, r.before) for p in r.wanted})
        else:
            if r.wanted and r.wanted[0] == r.before + 1:
                found[r.group][r.wanted[0]] = (r.lo, r.before)
                del r.wanted[0]
            if r.wanted:
                open_.append(r)

    for g, positions in asked.items():
        if g in ends:
            settle(_Range(g, ends[g]["lo"], ends[g]["hi"], 0, [p for p in positions if 1 <= p <= ends[g]["n"]]))
    while open_:
        ranges, open_ = open_, []
        table = rows.sparkSession.createDataFrame(
            [(r.group, k, *_finite(r, kind)) for k, r in enumerate(ranges)],
            f"group string, k int, least {kind}, most {kind}, lo {kind}, hi {kind}, wide boolean")
        inside = rows.join(F.broadcast(table), "group").filter(F.col("value").between(F.col("least"), F.col("most")))
        counts = inside.groupBy("k", _bucket(kind, buckets).alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
        for k, r in enumerate(ranges):
            before = r.before
            for c in sorted((c for c in counts if c["k"] == k), key=lambda c: c["b"]):
                here = [p for p in r.wanted if before < p <= before + c["n"]]
                if here:
                    settle(_Range(r.group, c["lo"], c["hi"], before, here))
                before += c["n"]
    return found


def _finite(r: _Range, kind: str) -> tuple:
    """least, most, lo, hi, wide: the range, its finite span, and whether the span
    overflows."""
    if kind == "double":
        lo, hi = (max(min(x, 1.7976931348623157e308), -1.7976931348623157e308) for x in (r.lo, r.hi))
        return r.lo, r.hi, lo, hi, math.isinf(hi - lo)
    return r.lo, r.hi, r.lo, r.hi, kind == "bigint" and r.hi - r.lo >= 1 << 63


def long_rows(df: DataFrame, columns: dict) -> DataFrame:
    """(group, value): the expressions ``columns`` (name -> SQL text) below
    one another."""
    parts = ", ".join(f"'{name}', {sql}" for name, sql in columns.items())
    return df.select(F.expr(f"stack({len(columns)}, {parts}) AS (group, value)"))


def quantile_positions(n: int, probs: list) -> dict:
    """p -> (position below, position above, fraction between), linear."""
    out = {}
    for p in probs:
        h = float(n - 1) * p
        at = math.floor(h)
        out[p] = (at + 1, min(at + 2, n), h - at)
    return out


def order_limits(df: DataFrame, measures: dict, tie: str, cuts) -> dict:
    """{measure: [(value, tie value) of the last row of each part]} where rows
    are ordered by the measure, then by the whole number column ``tie``.

    ``measures`` are whole-number SQL expressions; ``cuts`` gives, for the
    number of rows, the last position of every part but the last."""
    n_of = {}

    def positions(n):
        n_of.update(n)
        return {g: [p for p in cuts(k) if 1 <= p < k] for g, k in n.items()}

    at = select_positions(long_rows(df, {m: f"CAST({sql} AS BIGINT)" for m, sql in measures.items()}), positions, "bigint")
    # of a value that a cut divides, the rows below the cut end at one tie value
    ties, wanted = {}, {}
    for m, found in at.items():
        for p, (value, before) in found.items():
            name = f"{m}/{value}"
            ties[name] = f"CASE WHEN {measures[m]} = {value} THEN CAST(`{tie}` AS BIGINT) END"
            wanted.setdefault(name, set()).add(p - before)
    last = select_positions(long_rows(df, ties), {g: sorted(p) for g, p in wanted.items()}, "bigint") if ties else {}
    out = {}
    for m in measures:
        n = n_of.get(m, 0)
        out[m] = []
        for p in (cuts(n) if n else []):
            if p < 1:
                out[m].append(None)                       # an empty part at the start
            elif p < n:
                value, before = at[m][p]
                out[m].append((value, last[f"{m}/{value}"][p - before][0]))
    return out


def part_of(measure: str, tie: str, limits: list) -> Column:
    """Number, from 1, of the part of the order that a row falls into."""
    value, place = F.expr(measure).cast("bigint"), F.col(tie).cast("bigint")
    beyond = [F.lit(1) if limit is None else
              ((value > limit[0]) | ((value == limit[0]) & (place > limit[1]))).cast("int") for limit in limits]
    return reduce(lambda a, b: a + b, beyond, F.lit(1)).cast("bigint")


def ntile_cuts(k: int):
    """Cuts of NTILE(k): larger parts first."""
    def cuts(n: int) -> list:
        size, more = divmod(n, k)
        return [size * j + min(j, more) for j in range(1, k)]
    return cuts
