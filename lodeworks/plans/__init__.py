"""The warehouse's tables, each a function from DataFrames to a DataFrame."""
