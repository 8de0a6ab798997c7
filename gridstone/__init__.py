"""Spark-native analytics over dimensional, panel and text data."""
