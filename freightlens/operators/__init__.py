"""Operators that Spark does not offer ready-made."""
