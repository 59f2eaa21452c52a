"""Spark-native analytics over public health-cost data."""
