"""Batch analytics for order, purchasing, stock and receivables data on PySpark."""

__version__ = "0.1.0"
