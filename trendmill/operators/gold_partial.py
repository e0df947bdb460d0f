"""Gold by parts: aggregates of some (region, month) partitions of Silver that Gold can be folded from.

A day lies in one month, so figures per day are final within a part. A channel's figures are sums, counts and maxima per
month, which add up, and its videos and categories are kept as rows, because distinct counts do not. None of the parts
holds a name of a category: names may change without Silver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmill import functions as fn
from trendmill.operators import gold

_CHANNEL = ["channel_title", "region"]
_RATE = ("rate_whole", "rate_parts", "rate_count")
# What is summed over the months of a channel.
_ADDED = ("total_views", "total_likes", "total_comments", "views_counted", "times_trending", *_RATE)


def _by_month(groups: DataFrame) -> DataFrame:
    return groups.withColumn("trending_month", fn.month_of(F.col("trending_date_parsed")))


def _channel_values(stats: DataFrame, counted: str) -> DataFrame:
    return stats.select(*_CHANNEL, "trending_month", counted).distinct()


def _channel_sums(stats: DataFrame) -> DataFrame:
    rates = fn.rate_sums(F.col("engagement_rate"))
    return stats.groupBy(*_CHANNEL, "trending_month").agg(
        F.sum("views").alias("total_views"),
        F.sum("likes").alias("total_likes"),
        F.sum("comment_count").alias("total_comments"),
        F.count("views").alias("views_counted"),
        F.max("views").alias("peak_views"),
        F.count("trending_date_parsed").alias("times_trending"),
        *[value.alias(name) for name, value in zip(_RATE, rates)],
    )


def parts_of(stats: DataFrame) -> dict[str, DataFrame]:
    """The parts, by name, of Silver rows that have a ``trending_month``."""
    return {
        "days": _by_month(gold.trending_analytics(stats)),
        "categories": _by_month(gold.category_groups(stats)),
        "channels": _channel_sums(stats),
        "channel_videos": _channel_values(stats.filter(F.col("video_id").isNotNull()), "video_id"),
        "channel_categories": _channel_values(stats, "category_id"),
    }


def days_from_parts(parts: dict[str, DataFrame]) -> DataFrame:
    """``gold.trending_analytics`` of all rows."""
    keys = ["region", "trending_date_parsed"]
    days = parts["days"].drop("trending_month")
    return days.select(*keys, *[c for c in days.columns if c not in keys])


def categories_from_parts(parts: dict[str, DataFrame], lookup: DataFrame | None) -> DataFrame:
    """``gold.category_analytics`` of all rows."""
    return gold.category_shares(parts["categories"].drop("trending_month"), lookup)


def channels_from_parts(parts: dict[str, DataFrame], lookup: DataFrame | None) -> DataFrame:
    """``gold.channel_analytics`` of all rows."""
    months = parts["channels"].groupBy(*_CHANNEL).agg(
        *[F.sum(name).alias(name) for name in _ADDED], F.max("peak_views").alias("peak_views"))
    sums = months.select(
        *_CHANNEL, "total_views", "total_likes", "total_comments",
        F.try_divide("total_views", "views_counted").alias("avg_views_per_video"),
        fn.average_from_rate_sums(*[F.col(name) for name in _RATE]).alias("avg_engagement_rate"),
        "peak_views", "times_trending")
    return gold.rank_channels(gold.channel_rows(sums, parts["channel_videos"], parts["channel_categories"], lookup))
