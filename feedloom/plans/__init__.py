"""Whole jobs built from the operators, and the configured employee feed."""
