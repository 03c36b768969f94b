"""Readers of vendor payload files."""
