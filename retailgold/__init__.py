"""Spark-native build, validation and publication of retail point-of-sale gold tables."""
