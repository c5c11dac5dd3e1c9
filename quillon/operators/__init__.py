"""Operators on flat step tables."""
