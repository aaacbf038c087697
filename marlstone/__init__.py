"""Spark-native engine for register data: versioned facts, true deltas, audits and training-data preparation."""

__version__ = "0.1.0"
