"""Continuous variants of ingestion and event measures. An extension: batch results are what it is checked against."""
