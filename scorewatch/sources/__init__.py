"""Readers for tables, streams and connectors."""
