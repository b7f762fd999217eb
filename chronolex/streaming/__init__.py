"""Unbounded input."""
