"""Reusable operators: global ordered statistics, quality checks."""
