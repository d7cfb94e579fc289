"""Readers, payload flattening and table write rules."""
