"""Spark-native text-to-graph engine."""
