"""Spark-native engine for large catalogues of scientific names."""
