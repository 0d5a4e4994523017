"""Retail sales, sell-out and customer-value analytics as Spark DataFrame operators."""

__version__ = "0.1.0"
