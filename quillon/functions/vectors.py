"""Slices of array columns with the bounds of Python slices. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def part(a: Column, start: int | None = None, stop: int | None = None) -> Column:
    """``a[start:stop]``: negative bounds count from the end, and both are clamped.

    (The built-in slice gives nothing where a negative start lies before the array.)"""
    n = F.size(a)

    def bound(x: int | None, default: Column) -> Column:
        if x is None:
            return default
        return F.least(F.lit(x), n) if x >= 0 else F.greatest(n + x, F.lit(0))

    low, high = bound(start, F.lit(0)), bound(stop, n)
    return F.slice(a, low + 1, F.greatest(high - low, F.lit(0)))


def parts(a: Column, bounds: list[tuple[int | None, int | None]]) -> Column:
    """Several slices, joined. The element type stays."""
    return F.concat(*[part(a, *b) for b in bounds])


def every(a: Column, step: int) -> Column:
    """``a[::step]``."""
    return F.filter(a, lambda _, i: i % step == 0)


def last(a: Column) -> Column:
    """The last element, null for an empty array."""
    return F.get(a, F.size(a) - 1)


def unnested(a: Column, names: list[str]) -> list[Column]:
    """Elements as columns; missing ones are null."""
    return [F.get(a, i).alias(x) for i, x in enumerate(names)]
