"""Descriptive analytics over large product-review collections, on Spark DataFrames.

Every operator takes a DataFrame (or columns) and returns a DataFrame (or columns);
nothing runs until the caller asks for a result, except the few functions whose
docstring says that they start a job.
"""
