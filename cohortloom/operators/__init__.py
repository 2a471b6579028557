"""Operators: each takes DataFrames and returns a DataFrame, and none starts a job."""
