"""Readers, writers and generated input tables."""
