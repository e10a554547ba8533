"""Scoring of streamed rows with a fitted workflow."""
