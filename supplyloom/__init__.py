"""Supplier-qualification and purchase-order reporting as Spark DataFrame jobs."""

__version__ = "0.1.0"
