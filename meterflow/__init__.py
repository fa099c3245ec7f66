"""Metric pipelines as plain PySpark ``DataFrame -> DataFrame`` functions."""
