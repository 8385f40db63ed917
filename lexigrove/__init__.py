"""Spark-native analytics over collections of structured documents."""
