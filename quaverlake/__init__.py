"""Annotation dataflows over media-like records, declared on Spark DataFrames."""
