"""Operators on record streams and on put requests."""
