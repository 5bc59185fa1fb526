"""Compound and target pair analytics as Spark DataFrame operators."""
