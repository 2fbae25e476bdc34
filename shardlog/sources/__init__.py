"""Reading and writing the stored log."""
