"""Data-lake operators for Spark: ingest, repair, merge, report, export.

Every operator is a function from DataFrames to a DataFrame. Nothing reads the wall clock: a function whose result
depends on "today" takes the day as an argument.
"""
