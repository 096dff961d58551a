"""Spark-native analytics over aerial field surveys."""
