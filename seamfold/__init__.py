"""Ordered-event folds, text checks and dataset assembly as Spark DataFrame operators."""

__version__ = "0.1.0"
