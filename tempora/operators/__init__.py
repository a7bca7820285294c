"""Relational operators of the register as functions from DataFrames to DataFrames."""
