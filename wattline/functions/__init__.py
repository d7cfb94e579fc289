"""Column-level helpers and fixed reference values."""
