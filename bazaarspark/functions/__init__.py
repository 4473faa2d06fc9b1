"""Column-level functions. Everything here takes and returns Columns."""
