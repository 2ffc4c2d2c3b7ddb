"""Spark-native dataset construction engine."""

__version__ = "0.1.0"
