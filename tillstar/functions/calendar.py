"""Calendar attribute expressions for the date dimension and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """YYYYMMDD integer key, computed arithmetically (no string formatting)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def key_to_date(k: Column) -> Column:
    return F.to_date(k.cast("string"), "yyyyMMdd")


def quarter_label(d: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "), F.year(d).cast("string"))


def month_label(d: Column) -> Column:
    return F.date_format(d, "MMM yyyy")


def fiscal_year(d: Column) -> Column:
    """Fiscal year starts in April and is named by its starting calendar year."""
    return F.when(F.month(d) >= 4, F.year(d)).otherwise(F.year(d) - 1)


def fiscal_quarter(d: Column) -> Column:
    m = F.month(d)
    return (F.when(m.isin(4, 5, 6), 1).when(m.isin(7, 8, 9), 2)
            .when(m.isin(10, 11, 12), 3).otherwise(4))


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Whole months between two month starts: (y2-y1)*12 + (m2-m1)."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))
