"""Recurring-revenue and product-usage analytics as plain PySpark DataFrame functions."""
