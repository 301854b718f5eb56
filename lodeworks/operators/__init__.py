"""Operators over DataFrames that more than one plan uses."""
