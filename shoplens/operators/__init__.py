"""The analyses: lazy functions from DataFrames and parameters to a DataFrame."""
