"""Spark-native operators for layered (raw -> standardised -> harmonised -> curated) tables."""

__version__ = "0.1.0"
