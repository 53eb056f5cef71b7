"""Operators for preparing training data, each on whole DataFrames."""
