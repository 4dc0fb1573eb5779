"""Spark-native analytics over ordered frame streams."""
