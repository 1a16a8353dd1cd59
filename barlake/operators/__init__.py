"""Operators: pure ``DataFrame -> DataFrame`` functions with explicit as-of times."""
