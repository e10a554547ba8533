"""User-level jobs built from the operators."""
