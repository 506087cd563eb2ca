"""Sources (test-data adapter, CSV/parquet readers) and sinks."""
