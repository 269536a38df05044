"""Operators for the preparation of training text, each a function from DataFrames to a DataFrame."""
