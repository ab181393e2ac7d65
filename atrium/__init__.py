"""Spark-native analytics of annotated indoor scenes."""
