"""Reorg-safe block and event-log analytics on PySpark."""

__version__ = "0.1.0"
