"""Operators of a training-data pipeline: text, page and vector tables in,
DataFrames out.  Nothing else in the library imports this subpackage."""
