"""Spark-native identifier normalization and corpus preparation."""
