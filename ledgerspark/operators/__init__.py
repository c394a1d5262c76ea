"""Joins, windows, merges and graph jobs over DataFrames."""
