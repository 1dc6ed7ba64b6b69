"""Tessera: a PySpark-native document ingestion and analytics engine."""
