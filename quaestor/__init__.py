"""Spark-first retrieval and analytics over document collections."""
