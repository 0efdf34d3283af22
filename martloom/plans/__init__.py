"""Whole jobs composed from the operators: ingestion, dimensions, facts, pipelines."""
