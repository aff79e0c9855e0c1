"""Transformations from DataFrames to DataFrames; nothing here runs a job."""
