"""Readers of extracts, logs and driver tables."""
