"""Numeric parse of text cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal numbers.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(c: Column) -> Column:
    """Double, or null where the cell is not a plain decimal number.

    A bare ``try_cast`` would accept ``12d`` and ``nan``; the pattern rules those out. Numbers beyond the range of a
    double are null, too.
    """
    x = c.try_cast("double")
    return F.when(c.rlike(NUMBER) & (F.abs(x) < float("inf")), x)  # the pattern is matched once


def finite(x: Column) -> Column:
    """The number, or null where it is NaN or infinite."""
    return F.when(F.abs(x) < float("inf"), x)


def is_whole(x: Column) -> Column:
    """True where a double has no fraction and fits a 64-bit integer."""
    return (x % 1 == 0) & (F.abs(x) < 9.0e18)


def share(part: Column, whole: Column) -> Column:
    """part / whole, null when whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def rounded(x: Column, digits: int) -> Column:
    """Half to even on the scaled double, as numpy rounds."""
    scale = float(10**digits)
    return F.rint(x * scale) / scale


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return rounded(share(part, whole) * 100, digits)


def expand_year(y: Column) -> Column:
    """Two-digit years become four-digit ones; everything else stays."""
    return (
        F.when((y >= 0) & (y < 30), y + 2000)
        .when((y >= 30) & (y < 100), y + 1900)
        .otherwise(y)
    )
