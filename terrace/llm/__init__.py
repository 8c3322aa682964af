"""Operators of a training-data pipeline, from DataFrames of documents to DataFrames."""
