"""Staged tables and written artifacts."""
