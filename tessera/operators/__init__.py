"""Operators on records and pairs: DataFrames in, DataFrames out."""
