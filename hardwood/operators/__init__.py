"""Merge, history, key and quality operators on plain DataFrames."""
