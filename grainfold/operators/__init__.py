"""Operators on DataFrames; column names are arguments."""
