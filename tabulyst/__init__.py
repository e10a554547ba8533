"""Tabular regression analytics on Spark: profile, prepare, fit, compare, score."""
