"""Spark-native product-catalogue analytics: DataFrame operators over captured pages, feeds and catalogue tables."""
