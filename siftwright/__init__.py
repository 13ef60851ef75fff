"""Spark-native ingestion, validation and reporting of untrusted delimited files."""

__version__ = "0.1.0"
