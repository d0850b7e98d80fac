"""Everyday batch analytics as plain Spark jobs."""
