"""Spark-native analytics for e-commerce behaviour events."""
