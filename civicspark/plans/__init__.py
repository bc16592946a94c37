"""Analytical queries: functions from a table mapping to a lazy DataFrame."""
