"""The published datasets, each a function from DataFrames to a DataFrame."""
