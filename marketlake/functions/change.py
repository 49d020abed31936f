"""Absolute and percentage change against an opening value."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def change(price: Column, opening: Column) -> Column:
    return price - opening


def change_percentage(price: Column, opening: Column) -> Column:
    """``100 * (price - open) / open``; null when the open is zero."""
    return F.try_divide(F.lit(100.0) * (price - opening), opening)
