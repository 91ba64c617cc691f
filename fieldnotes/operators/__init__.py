"""Operators on DataFrames: parse, measures, balance, vectors, forest,
search, checks."""
