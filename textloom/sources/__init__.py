"""Readers, sinks and fixed reference values."""
