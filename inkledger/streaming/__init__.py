"""Continuous ingestion, approval log and running totals."""
