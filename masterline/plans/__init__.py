"""Schemas, flows and the query catalogue."""
