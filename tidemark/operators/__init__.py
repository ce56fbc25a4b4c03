"""Operators: each takes DataFrames and returns DataFrames, without an action."""
