"""tillstar — a Spark-native retail analytics warehouse.

Raw order lines are profiled, cleaned and de-duplicated, loaded into a star
schema (one sales fact, six dimensions) and queried through a layer of KPI,
customer, marketing, window-function and executive reports.  Every report is
a function ``Warehouse -> DataFrame`` built from DataFrame expressions, so
Catalyst plans it and the cluster executes it.
"""

from tillstar.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
