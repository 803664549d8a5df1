"""Joins, loads, aggregations and rankings as DataFrame-to-DataFrame functions."""
