"""Variant analytics on Spark: sources, operators and plans as DataFrame code."""

__version__ = "0.1.0"
