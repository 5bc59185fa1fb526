"""Operators composed to the pair table and its artifacts."""
