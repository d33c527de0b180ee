"""Quire: a Spark-native engine that turns document collections into retrieval-ready tables."""

__version__ = "0.1.0"
