"""Money as decimals; doubles appear nowhere inside the engine."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from slipmatch.schemas import TOTAL


def or_zero(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(0))


def row_total(columns: Iterable[str]) -> Column:
    """Sum of the named measures, NULL counting as nothing."""
    total = None
    for name in columns:
        total = or_zero(name) if total is None else total + or_zero(name)
    return total


def cents(c: Column) -> Column:
    """Rounded once, to the scale at which two systems are compared."""
    return c.cast(TOTAL)
