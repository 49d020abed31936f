"""String helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_name(c: Column | str) -> Column:
    """Lower case without spaces, hyphens and underscores; null gives ''."""
    return F.translate(F.lower(F.coalesce(_col(c), F.lit(""))), " -_", "")


def pair_symbol(base: Column | str, quote: Column | str) -> Column:
    """``BASE-QUOTE``; null when either side is null."""
    return F.concat(_col(base), F.lit("-"), _col(quote))


def split_list(c: Column | str) -> Column:
    """Comma separated text to an array of trimmed items."""
    return F.transform(F.split(_col(c), ","), lambda item: F.trim(item))


def flag_to_int(c: Column | str) -> Column:
    """1 for a true boolean or the text "true" in any case, otherwise 0."""
    return F.coalesce(F.lower(_col(c).cast("string")) == "true", F.lit(False)).cast("int")


def strip_suffix(names: Iterable[str], suffix: str = "_str") -> dict[str, str]:
    """Map of every column name to its name without ``suffix``."""
    return {n: n.removesuffix(suffix) for n in names}
