"""Declarative schemas, specs and target projections, compiled to columns."""
