"""Readers of landed raw data and the table store."""
