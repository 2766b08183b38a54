"""Spark-native document ingestion, retrieval and corpus analytics."""
