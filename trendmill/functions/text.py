"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_region(col: Column) -> Column:
    return F.lower(F.trim(col))


def has_text(col: Column) -> Column:
    """Not null and not only white space (of any kind: tabs, no-break and ideographic spaces too)."""
    return F.coalesce(col.rlike(r"(?U)\S"), F.lit(False))


def pipe_join(col: Column) -> Column:
    """['a', 'b'] -> 'a|b'; an empty or missing array -> null."""
    return F.when(F.size(col) > 0, F.array_join(col, "|"))
