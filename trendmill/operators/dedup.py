"""Keep one row per key, always the same one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendmill.schemas import REFERENCE_KEY, STATISTICS_KEY

# Set by the run itself, so they only break ties between rows that are otherwise equal.
_VOLATILE = ("_processed_at", "_job_name", "source_file", "origin_batch", "feed", "batch_id")


def latest_per_key(df: DataFrame, keys: list[str] | tuple[str, ...], newest: list[str]) -> DataFrame:
    """The row of every key with the highest values in the columns ``newest``, compared in that order.

    After them every other column breaks ties (descending, nulls last), so the survivor does not depend
    on the order rows arrive in. Filtering ``row_number() = 1`` lets Spark keep one row per key and task
    before the shuffle (WindowGroupLimit), so a key that holds a large part of all rows sends at most
    one row per map task to its reducer.
    """
    rest = [c for c in df.columns if c not in {*keys, *newest, *_VOLATILE}]
    order = [*newest, *rest, *(c for c in _VOLATILE if c in df.columns)]
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    placed = df.select("*", F.row_number().over(newest_first).alias("_place_in_key"))
    return placed.where("_place_in_key = 1").select(*df.columns)


def latest_statistics(df: DataFrame) -> DataFrame:
    """One row per (video_id, region, trending_date_parsed).

    The newest source time wins where rows carry one; a row without (the backfill) loses to a row with.
    Then the highest counters win: counters only grow, so the largest are the latest.
    """
    return latest_per_key(df, STATISTICS_KEY, _newest_statistics(df))


def latest_per_file(df: DataFrame) -> DataFrame:
    """One row per key and source file, by the rule of ``latest_statistics``.

    Rows without a file count as one more file. What this leaves decides every key as all rows would, also after some
    of the files are taken away.
    """
    return latest_per_key(df, [*STATISTICS_KEY, "source_file"], _newest_statistics(df))


def _newest_statistics(df: DataFrame) -> list[str]:
    times = [c for c in ("_source_time",) if c in df.columns]
    return [*times, "views", "likes", "comment_count"]


def latest_reference(df: DataFrame) -> DataFrame:
    """One row per (region, category_id), the most recently ingested."""
    return latest_per_key(df, REFERENCE_KEY, ["_source_time"])
