"""Whole pipelines composed from the operators."""
