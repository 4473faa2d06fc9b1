"""Relational building blocks that take and return DataFrames."""
