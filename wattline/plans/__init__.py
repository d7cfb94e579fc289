"""Composed feature and layer plans."""
