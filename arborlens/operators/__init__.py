"""Operators: DataFrame to DataFrame."""
