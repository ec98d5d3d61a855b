"""Spatial methylation and read-count analytics as composable PySpark DataFrame operations."""

__version__ = "0.1.0"
