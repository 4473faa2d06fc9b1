"""Whole transformations: landed payloads to staging, staging to marts, marts to views and alerts.

Every function takes DataFrames and an as-of date and returns a DataFrame. Nothing here runs a job, except
where a caller asks for an intermediate result to be materialized, and `run`.
"""
