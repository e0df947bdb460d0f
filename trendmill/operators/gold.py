"""The three Gold aggregates.

``stats`` is Silver statistics, ``lookup`` the result of ``reference.measured_lookup`` or None.

Distinct counts are computed beside the sums, not together with them: several DISTINCT aggregates in one
groupBy make Spark multiply every row before the first shuffle. Each side reads only its few columns,
drops repeats within its task, and spreads a hot group over all tasks by the counted value. The sides
are stacked and folded, one row per group and side, so no join is needed and null keys need no care.
Nothing is cached: re-reading columns is cheaper than a second copy of Silver, and survives a lost
executor.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendmill import functions as fn
from trendmill.operators.ranking import row_number_by_range
from trendmill.operators.reference import enrich_category


def _totals() -> list[Column]:
    return [
        F.sum("views").alias("total_views"),
        F.sum("likes").alias("total_likes"),
        F.sum("comment_count").alias("total_comments"),
    ]


def _distinct_count(stats: DataFrame, keys: list[str], counted: str, name: str) -> DataFrame:
    pairs = stats.filter(F.col(counted).isNotNull()).select(*keys, counted).distinct()
    return pairs.groupBy(*keys).agg(F.count("*").alias(name))


def _fold(keys: list[str], sides: list[DataFrame], columns: list[Column]) -> DataFrame:
    """One row per key from sides that each fill their own columns."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    return stacked.groupBy(*keys).agg(*columns)


def _only(name: str) -> Column:
    return F.max(name).alias(name)


def _count_or_zero(name: str) -> Column:
    return F.coalesce(F.max(name), F.lit(0).cast("bigint")).alias(name)


def trending_analytics(stats: DataFrame) -> DataFrame:
    """Daily figures per region. Rows without a date form their own group."""
    keys = ["region", "trending_date_parsed"]
    sums = stats.groupBy(*keys).agg(
        F.count("video_id").alias("total_videos"),
        *_totals(),
        fn.average_of_counts(F.col("views")).alias("avg_views_per_video"),
        fn.average_of_rates(F.col("like_ratio")).alias("avg_like_ratio"),
        fn.average_of_rates(F.col("engagement_rate")).alias("avg_engagement_rate"),
        F.max("views").alias("max_views"),
    )
    channels = _distinct_count(stats, keys, "channel_title", "unique_channels")
    categories = _distinct_count(stats, keys, "category_id", "unique_categories")
    measures = [_only(name) for name in sums.columns if name not in keys]
    return _fold(keys, [sums, channels, categories],
                 [*measures, _count_or_zero("unique_channels"), _count_or_zero("unique_categories")])


def channel_totals(stats: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Figures per channel and region, without the rank. The category names are a sorted set."""
    keys = ["channel_title", "region"]
    sums = stats.groupBy(*keys).agg(
        *_totals(),
        fn.average_of_counts(F.col("views")).alias("avg_views_per_video"),
        fn.average_of_rates(F.col("engagement_rate")).alias("avg_engagement_rate"),
        F.max("views").alias("peak_views"),
        F.count("trending_date_parsed").alias("times_trending"),
    )
    return channel_rows(sums, stats, stats, lookup)


def channel_rows(sums: DataFrame, videos: DataFrame, categories: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Sums per channel and region, with the number of its videos and the names of its categories.

    ``videos`` and ``categories`` hold the channel, region and the video or category id, any number of times.
    """
    keys = ["channel_title", "region"]
    counted = _distinct_count(videos, keys, "video_id", "total_videos")
    named = enrich_category(categories.select(*keys, "category_id").distinct(), lookup)
    measures = [_only(name) for name in sums.columns if name not in keys]
    return _fold(keys, [sums, counted, named.select(*keys, "category_name")],
                 [_count_or_zero("total_videos"), *measures,
                  F.array_sort(F.collect_set("category_name")).alias("categories")])


def rank_channels(totals: DataFrame) -> DataFrame:
    """Add the rank by views within the region (ties: channel title)."""
    order = [F.col("total_views").desc_nulls_last(), F.col("channel_title").asc_nulls_first()]
    return row_number_by_range(totals, "region", order, "rank_in_region")


def channel_analytics(stats: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Figures per channel and region, ranked by views within the region."""
    return rank_channels(channel_totals(stats, lookup))


def category_groups(stats: DataFrame) -> DataFrame:
    """Figures per category id, region and day."""
    keys = ["category_id", "region", "trending_date_parsed"]
    sums = stats.groupBy(*keys).agg(
        F.count("video_id").alias("video_count"),
        *_totals(),
        fn.average_of_rates(F.col("engagement_rate")).alias("avg_engagement_rate"),
    )
    channels = _distinct_count(stats, keys, "channel_title", "unique_channels")
    measures = [_only(name) for name in sums.columns if name not in keys]
    return _fold(keys, [sums, channels], [*measures, _count_or_zero("unique_channels")])


def category_analytics(stats: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Figures per category, region and day, with the category's share of that day's views.

    The name depends on the id alone, so rows are grouped by id and named afterwards: the join sees
    aggregated rows only. The share's window holds one row per category of a day and region.
    A day without any views has no share (null).
    """
    return category_shares(category_groups(stats), lookup)


def category_shares(grouped: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Add the category's name and its share of the day's views to ``category_groups``."""
    day = F.sum("total_views").over(Window.partitionBy("region", "trending_date_parsed"))
    share = F.round(F.try_divide(F.col("total_views"), day) * 100, 2)
    return enrich_category(grouped, lookup).withColumn("view_share_pct", share).select(
        "category_name", "category_id", "region", "trending_date_parsed", "video_count", "total_views",
        "total_likes", "total_comments", "avg_engagement_rate", "unique_channels", "view_share_pct",
    )


def stamp_aggregated(df: DataFrame) -> DataFrame:
    return df.withColumn("_aggregated_at", F.current_timestamp())
