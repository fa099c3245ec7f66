"""Output formats and writers."""
