"""Continuous ingest and standing queries."""
