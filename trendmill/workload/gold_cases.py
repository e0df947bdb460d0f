"""Lookup, enrichment, the three Gold tables and the five reports."""

from __future__ import annotations

from trendmill.operators import gold, reference
from trendmill.plans import reports
from trendmill.workload.tables import LOOKUP_SQL, STATS_SQL, facts, lookup, over, portable, published, silver

REGION = "america"

_ENRICHED = f"""
    select s.*, coalesce(c.category_name, 'Unknown') as category_name
    from ({STATS_SQL}) s left join ({LOOKUP_SQL}) c on s.category_id = c.category_id
"""


def _rate_mean(column: str) -> str:
    return f"cast(sum(cast({column} as decimal(18,4))) as double) / count({column})"


_TRENDING = f"""
    select region, trending_date_parsed,
           count(video_id) as total_videos,
           cast(sum(views) as bigint) as total_views,
           cast(sum(likes) as bigint) as total_likes,
           cast(sum(comment_count) as bigint) as total_comments,
           cast(sum(views) as double) / count(views) as avg_views_per_video,
           {_rate_mean('like_ratio')} as avg_like_ratio,
           {_rate_mean('engagement_rate')} as avg_engagement_rate,
           max(views) as max_views,
           count(distinct channel_title) as unique_channels,
           count(distinct category_id) as unique_categories
    from ({STATS_SQL}) group by region, trending_date_parsed
"""
_CHANNEL_BASE = f"""
    select channel_title, region,
           count(distinct video_id) as total_videos,
           cast(sum(views) as bigint) as total_views,
           cast(sum(likes) as bigint) as total_likes,
           cast(sum(comment_count) as bigint) as total_comments,
           cast(sum(views) as double) / count(views) as avg_views_per_video,
           {_rate_mean('engagement_rate')} as avg_engagement_rate,
           max(views) as peak_views,
           count(trending_date_parsed) as times_trending,
           list_sort(list(distinct category_name)) as names
    from ({_ENRICHED}) group by channel_title, region
"""
_CHANNEL = f"""
    select *, row_number() over (partition by region order by total_views desc, channel_title) as rank_in_region
    from ({_CHANNEL_BASE})
"""
_CATEGORY = f"""
    select *, round(total_views * 1.0
                    / nullif(sum(total_views) over (partition by region, trending_date_parsed), 0) * 100, 2)
              as view_share_pct
    from (
        select category_name, category_id, region, trending_date_parsed,
               count(video_id) as video_count,
               cast(sum(views) as bigint) as total_views,
               cast(sum(likes) as bigint) as total_likes,
               cast(sum(comment_count) as bigint) as total_comments,
               {_rate_mean('engagement_rate')} as avg_engagement_rate,
               count(distinct channel_title) as unique_channels
        from ({_ENRICHED}) group by category_name, category_id, region, trending_date_parsed
    )
"""

# Reference rows from parts: the size is the category id, the brand the region; economy parts have no name.
_PART_REFERENCE = """
    select cast(p_size as bigint) as category_id, lower(p_brand) as region,
           case when p_type = 'ECONOMY' then null else p_name end as category_name
    from {part}
"""


def _trending(spark, sf_dir):
    return gold.trending_analytics(silver(spark, sf_dir))


def _channels(spark, sf_dir):
    return gold.channel_analytics(silver(spark, sf_dir), lookup(spark, sf_dir))


def _categories(spark, sf_dir):
    return gold.category_analytics(silver(spark, sf_dir), lookup(spark, sf_dir))


def _gold(spark, sf_dir, name):
    """A Gold table as its readers see it."""
    return spark.table(published(spark, sf_dir).table(f"{name}_analytics"))


QUERIES = {
    "category_lookup": lambda s, d: reference.category_lookup(over(s, d, _PART_REFERENCE, "part")),
    "enrich_category": lambda s, d: portable(
        reference.enrich_category(facts(s, d), lookup(s, d)).select(
            "video_id", "region", "trending_date_parsed", "channel_title", "category_id", "views", "category_name")),
    "enrich_without_lookup": lambda s, d: reference.enrich_category(facts(s, d), None).groupBy(
        "region", "category_name").count().withColumnRenamed("count", "n"),
    "gold_trending": lambda s, d: portable(_trending(s, d)),
    "gold_channel": lambda s, d: portable(_channels(s, d)),
    "gold_category": lambda s, d: portable(_categories(s, d)),
    "q1_top_channels": lambda s, d: portable(reports.top_channels(_gold(s, d, "channel"), REGION)),
    "q2_category_share": lambda s, d: reports.category_share(_gold(s, d, "category"), REGION),
    "q3_region_volume": lambda s, d: reports.region_volume(_gold(s, d, "trending")),
    "q4_peak_day": lambda s, d: portable(reports.peak_day(_gold(s, d, "trending"))),
    "q5_versatile_channels": lambda s, d: reports.versatile_channels(_gold(s, d, "channel"), REGION),
}

SQL = {
    "category_lookup": f"""
        select category_id, category_name from (
            select *, row_number() over (partition by category_id order by region, category_name) as rn
            from ({_PART_REFERENCE.format(part='part')}) where category_name is not null
        ) where rn = 1
    """,
    "enrich_category": f"""
        select video_id, region, cast(trending_date_parsed as varchar) as trending_date_parsed, channel_title,
               category_id, views, category_name
        from ({_ENRICHED})
    """,
    "enrich_without_lookup": f"""
        select region, 'Unknown' as category_name, count(*) as n from ({STATS_SQL}) group by region
    """,
    "gold_trending": f"""
        select * replace (cast(trending_date_parsed as varchar) as trending_date_parsed) from ({_TRENDING})
    """,
    "gold_channel": f"""
        select * exclude (names), array_to_string(names, '|') as categories from ({_CHANNEL})
    """,
    "gold_category": f"""
        select * replace (cast(trending_date_parsed as varchar) as trending_date_parsed) from ({_CATEGORY})
    """,
    "q1_top_channels": f"""
        select channel_title, total_views, times_trending, rank_in_region from ({_CHANNEL})
        where region = '{REGION}' order by total_views desc, channel_title limit 10
    """,
    "q2_category_share": f"""
        select category_name, cast(sum(total_views) as bigint) as views, round(avg(view_share_pct), 2) as avg_share_pct
        from ({_CATEGORY}) where region = '{REGION}'
        group by category_name order by views desc, category_name limit 10
    """,
    "q3_region_volume": f"""
        select region, count(*) as days_tracked, cast(sum(total_videos) as bigint) as total_trending_videos,
               round(avg(avg_engagement_rate), 4) as avg_engagement
        from ({_TRENDING}) group by region order by total_trending_videos desc, region
    """,
    "q4_peak_day": f"""
        with t as ({_TRENDING})
        select region, cast(trending_date_parsed as varchar) as trending_date_parsed, total_views, total_videos
        from t where total_views = (select max(total_views) from t m where m.region = t.region)
        order by total_views desc, region, trending_date_parsed
    """,
    "q5_versatile_channels": f"""
        select channel_title, region, cast(len(names) as bigint) as category_count, total_views
        from ({_CHANNEL_BASE}) where region = '{REGION}'
        order by category_count desc, total_views desc, channel_title limit 10
    """,
}
