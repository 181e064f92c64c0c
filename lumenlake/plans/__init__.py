"""Layered plans: raw, normalised, served, analysed, masked."""
