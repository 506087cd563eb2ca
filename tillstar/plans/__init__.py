"""Report plans: each report is ``Warehouse -> DataFrame``."""
