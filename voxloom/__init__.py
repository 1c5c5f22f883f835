"""Spark-native curation and quality analytics for multi-source speech records."""
