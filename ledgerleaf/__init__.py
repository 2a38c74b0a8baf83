"""Spark-native evaluation and preparation of structured-document data."""

__version__ = "0.1.0"
