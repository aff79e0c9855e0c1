"""Feeds, batches, raw tables and exports."""
