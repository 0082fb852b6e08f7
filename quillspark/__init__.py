"""Spark-native engine for source-preserving text corpora, evidence extraction and reversible entity resolution."""
