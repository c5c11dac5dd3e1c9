"""Recordings as they arrive."""
