"""Metric expressions written once and reused by every report.

Rounding contract (shared with the SQL oracle): money sums stay exact
DECIMAL and are rounded there; a ratio or average is computed in DOUBLE,
snapped to DECIMAL(38,10) to absorb binary noise, then rounded HALF_UP.
Outputs are DOUBLE for money and ratios, BIGINT for counts and ranks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SNAP = "decimal(38,10)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dbl(x) -> Column:
    return _c(x).cast("double")


def big(x) -> Column:
    return _c(x).cast("bigint")


def snap_round(x: Column, scale: int = 2) -> Column:
    """HALF_UP rounding of a double through an exact decimal."""
    return F.round(x.cast(SNAP), scale).cast("double")


def ratio(num, den, scale: int = 2, factor: float = 1.0) -> Column:
    """round(num / nullif(den, 0) * factor, scale); null when den is 0."""
    q = dbl(num) / F.nullif(dbl(den), F.lit(0.0))
    if factor != 1.0:
        q = q * F.lit(factor)
    return snap_round(q, scale)


def pct(num, den, scale: int = 2) -> Column:
    return ratio(num, den, scale, 100.0)


def money(x, scale: int = 2) -> Column:
    """ROUND(decimal, 2) as DOUBLE (exact decimal rounding first)."""
    return F.round(_c(x), scale).cast("double")


def avg_of(x, scale: int = 2) -> Column:
    """ROUND(AVG(x), scale): exact sum / non-null count."""
    return ratio(F.sum(_c(x)), F.count(_c(x)), scale)


# --- aggregate building blocks -------------------------------------------
# The fact grain is one row per order_id (enforced by the keep-first
# de-duplication and audited by the unique-key check), so COUNT(DISTINCT
# order_id) over fact rows equals COUNT(*): no distinct aggregation needed.

def orders_count() -> Column:
    return F.count(F.lit(1))


def sum_revenue() -> Column:
    return F.sum("revenue")


def sum_profit() -> Column:
    return F.sum("profit")


def aov(revenue_sum: Column, orders: Column) -> Column:
    return ratio(revenue_sum, orders)


def margin_pct(profit_sum: Column, revenue_sum: Column) -> Column:
    return pct(profit_sum, revenue_sum)


def return_rate_pct() -> Column:
    return pct(F.sum("is_returned"), F.count(F.lit(1)))


def discount_rate_pct() -> Column:
    return pct(F.sum("discount_amount"), F.sum("gross_revenue"))


def share_pct(part: Column, total: Column) -> Column:
    return pct(part, total)


def half_up_div(num: Column, den: Column) -> Column:
    """Exact integer HALF_UP division num/den for den > 0, sign-aware.

    Integer arithmetic (``div``) keeps results identical across engines where
    a floating-point quotient would differ in the last place."""
    a = F.abs(num).cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    q = F.call_function("div", a * 2 + d, d * 2)
    return F.signum(num).cast("bigint") * q.cast("bigint")
