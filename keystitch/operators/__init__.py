"""Operators: DataFrames in, DataFrame out, lazy. None of them collects, and none reads a clock."""
