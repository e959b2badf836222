"""Operators: each takes DataFrames and returns a DataFrame, or a model where one is fitted."""
