"""Relational operators: every one maps DataFrames to a DataFrame and starts no job by itself,
except the few whose output columns or plan depend on data (each says so)."""
