"""Spark-native lakehouse for a game catalogue and its popularity metrics."""

__version__ = "0.1.0"
