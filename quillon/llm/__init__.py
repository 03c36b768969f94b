"""Operators on texts and records for training corpora; nothing outside this package imports it."""
