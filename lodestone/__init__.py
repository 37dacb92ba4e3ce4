"""Spark-native retrieval and dataset analytics."""
