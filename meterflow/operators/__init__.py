"""Operators on metric frames and plain tables; each takes and returns a DataFrame."""
