"""Operators of a training-data pipeline, each over plain DataFrames."""
