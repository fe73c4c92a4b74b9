"""Spark-native analytics over captured web pages and their link graph."""
