"""Continuous reading, appending, auditing and delivery."""
