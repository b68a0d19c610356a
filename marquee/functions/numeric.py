"""Arithmetic of the rating fold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_tenth_even(x: Column) -> Column:
    """Round to one decimal, ties to even on the binary value: ``rint(10x)/10``."""
    return F.rint(x * F.lit(10.0)) / F.lit(10.0)


def running_mean(avg: Column, n: Column, value: Column) -> Column:
    """Mean after adding one value to a mean of ``n`` values."""
    return (n * avg + value) / (n + F.lit(1))
