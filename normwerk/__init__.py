"""Spark-native engine for structured legal corpora."""
