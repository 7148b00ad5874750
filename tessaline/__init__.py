"""Spark-first operators for incremental document corpora."""

__version__ = "0.1.0"
