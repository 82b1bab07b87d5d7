"""Readers, order keys, fixtures and sinks."""
