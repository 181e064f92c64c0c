"""Billing lakehouse on Spark: ingest, normalise, serve, analyse, mask."""
