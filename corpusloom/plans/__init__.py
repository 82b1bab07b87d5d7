"""Composed jobs, query registry and SQL oracles."""
