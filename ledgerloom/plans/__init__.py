"""Report jobs: pure functions from DataFrames to a DataFrame.

Inputs carry the plain column names each docstring lists; a caller renames its own
tables to them. Dates, lists and names of organisations are parameters.
"""
