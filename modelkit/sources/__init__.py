"""Readers, writers and connectors."""
