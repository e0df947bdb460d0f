"""Row counts taken while the data passes, without a job of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trendmill import functions as fn
from trendmill.schemas import CORRUPT


def counted(df: DataFrame, observation: Observation, **extra: Column) -> DataFrame:
    """Count the rows of ``df`` (and ``extra`` aggregates) when the frame is written.

    The counts are exact if the frame is written without a shuffle after this point: Spark counts a
    task of the last stage once, but may count a task of an earlier stage again when it is re-run.
    """
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in extra.items()])


def ingest_summary(rows: DataFrame, id_column: str = "video_id") -> DataFrame:
    """Rows, bad lines and rows with an id of a Bronze batch per region; read it with ``keep_corrupt``."""
    good = F.col(CORRUPT).isNull()
    return rows.groupBy("region").agg(
        F.count_if(good).alias("rows_ok"),
        F.count_if(~good).alias("rows_bad"),
        F.count_if(fn.has_text(F.col(id_column))).alias("rows_with_id"),
    ).withColumn("succeeded", F.col("rows_bad") == 0)
