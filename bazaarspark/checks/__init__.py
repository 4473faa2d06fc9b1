"""Registered queries over the given tables and the SQL their results are compared with."""
