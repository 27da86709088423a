"""Spark-first lexicon building and text-data quality."""
