"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
_BYTES_PER_FIELD = 16


def broadcast_if_small(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Hint a broadcast if the rows and bytes of ``df`` are within bounds, else return it unhinted.

    The measuring job returns one row. Without the hint Spark joins by shuffle, and adaptive execution
    splits the partitions of hot keys.
    """
    text_bytes = sum(
        (F.coalesce(F.octet_length(F.col(name)), F.lit(0)) for name, kind in df.dtypes if kind == "string"),
        start=F.lit(_BYTES_PER_FIELD * len(df.columns)),
    )
    size = df.agg(F.count("*").alias("n"), F.sum(text_bytes.cast("bigint")).alias("bytes")).first()
    if size["n"] <= max_rows and (size["bytes"] or 0) <= max_bytes:
        return F.broadcast(df)
    return df
