"""Column functions on messages and sequence numbers."""
