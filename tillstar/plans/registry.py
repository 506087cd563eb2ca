"""Name -> query callable ``(spark, sf_dir) -> DataFrame`` for every report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillstar.plans.warehouse import warehouse_for


def _on_warehouse(view) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return view(warehouse_for(spark, sf_dir))
    run.__name__ = getattr(view, "__name__", "view")
    run.__doc__ = view.__doc__
    return run


def view_functions() -> dict:
    """Report name -> ``Warehouse -> DataFrame``."""
    from tillstar.plans import (customer, dirty_reports, executive, kpi, load_reports, marketing, notebook, quality_reports,
                                star_reports, windows)
    views = {}
    for mod in (kpi, customer, marketing, windows, executive, notebook, quality_reports, star_reports,
                dirty_reports, load_reports):
        views.update(mod.VIEWS)
    return views


def queries() -> dict:
    out = {name: _on_warehouse(v) for name, v in view_functions().items()}
    return out


def oracle_sql() -> dict:
    from tillstar.oracle import customer as ocus, dirty as odirty, executive as oexe, kpi as okpi, loads as oload
    from tillstar.oracle import marketing as omkt
    from tillstar.oracle import notebook as onb, quality as oq, star as ostar, windows as owin
    out = {}
    for mod in (okpi, ocus, omkt, owin, oexe, onb, oq, ostar, odirty, oload):
        out.update(mod.SQL)
    return out
