import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trendmill.operators import broadcasting, dedup, gold, ranking, reference

STATS = ("video_id string, region string, trending_date_parsed date, channel_title string, category_id long, "
         "views long, likes long, dislikes long, comment_count long, like_ratio double, engagement_rate double")


def _plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_dedup_is_independent_of_row_order(spark):
    rows = [("a", "us", None, t, v, n) for t in ("x", "y") for v in (1, 5) for n in range(3)]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "video_id string, region string, trending_date_parsed date, title string, views long, likes long")
        df = df.withColumn("comment_count", F.lit(0)).repartition(3)
        seen.add(tuple(dedup.latest_statistics(df).first()))
    assert seen == {("a", "us", None, "y", 5, 2, 0)}


def test_dedup_limits_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 as k", "id as v")
    plan = _plan(dedup.latest_per_key(df, ["k"], ["v"]))
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_newest_source_time_wins_over_counters(spark):
    df = spark.sql("""
        select * from values ('a', 'us', date'2024-05-01', 9L, timestamp'2024-05-01 09:00:00'),
                             ('a', 'us', date'2024-05-01', 1L, timestamp'2024-05-01 11:00:00'),
                             ('a', 'us', date'2024-05-01', 99L, cast(null as timestamp))
        as t(video_id, region, trending_date_parsed, views, _source_time)
    """).withColumns({"likes": F.lit(0), "comment_count": F.lit(0)})
    assert dedup.latest_statistics(df).first().views == 1


@pytest.mark.parametrize("slots", ["1", "7"])
def test_row_number_by_range_equals_window(spark, slots):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", slots)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # One region holds most rows, another is null, and many rows tie.
        df = spark.range(3000).selectExpr(
            "case when id % 10 < 7 then 'us' when id % 10 < 9 then 'gb' end as region",
            "cast(id % 40 as long) as views", "concat('c', id) as title")
        order = [F.col("views").desc_nulls_last(), F.col("title").asc_nulls_first()]
        got = ranking.row_number_by_range(df, "region", order, "rank")
        want = df.withColumn("rank", F.row_number().over(Window.partitionBy("region").orderBy(*order)))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_broadcast_only_below_the_bound(spark):
    df = spark.range(100)
    small, large = broadcasting.broadcast_if_small(df, max_rows=100), broadcasting.broadcast_if_small(df, max_rows=99)
    wide = broadcasting.broadcast_if_small(df.selectExpr("repeat('x', 1000) as s"), max_bytes=50_000)
    hinted = ["Hint" in d._jdf.queryExecution().logical().toString() for d in (small, large, wide)]
    assert hinted == [True, False, False]


def test_lookup_takes_first_region_with_a_name(spark):
    df = spark.createDataFrame(
        [(10, "Musik", "us"), (10, "Music", "gb"), (10, None, "ca"), (None, "x", "gb"), (24, None, "gb")],
        "category_id long, category_name string, region string")
    assert [tuple(r) for r in reference.category_lookup(df).collect()] == [(10, "Music")]


def test_missing_lookup_names_everything_unknown(spark):
    df = spark.createDataFrame([(1,), (None,)], "category_id long")
    assert reference.category_lookup(df) is None
    assert {r.category_name for r in reference.enrich_category(df, None).collect()} == {"Unknown"}


def test_gold_tables_agree_with_each_other(spark):
    rows = spark.range(2000).selectExpr(
        "cast(id % 97 as string) as video_id", "case when id % 3 = 0 then 'us' else 'gb' end as region",
        "date_add(date'2024-01-01', cast(id % 5 as int)) as trending_date_parsed",
        "case when id % 11 > 0 then concat('c', id % 13) end as channel_title",
        "case when id % 7 > 0 then id % 7 end as category_id", "id as views", "id % 50 as likes", "0L as dislikes",
        "id % 9 as comment_count", "round(id % 100 / 7, 4) as like_ratio", "round(id % 100 / 3, 4) as engagement_rate")
    lookup = spark.createDataFrame([(1, "One"), (2, "Two"), (3, "Two")], "category_id long, category_name string")
    trending = gold.trending_analytics(rows)
    channels = gold.channel_analytics(rows, lookup)
    categories = gold.category_analytics(rows, lookup)
    total = rows.agg(F.sum("views")).first()[0]
    for frame in (trending, channels, categories):
        assert frame.agg(F.sum("total_views")).first()[0] == total
    assert trending.count() == trending.dropDuplicates(["region", "trending_date_parsed"]).count()
    for row in channels.groupBy("region").agg(F.sort_array(F.collect_list("rank_in_region")).alias("r")).collect():
        assert row.r == list(range(1, len(row.r) + 1))
    for row in categories.groupBy("region", "trending_date_parsed").agg(
            F.sum("view_share_pct").alias("s"), F.count("*").alias("n")).collect():
        assert abs(row.s - 100) <= 0.005 * row.n + 1e-9
    plain = rows.groupBy("region", "trending_date_parsed").agg(
        F.count_distinct("channel_title").alias("a"), F.count_distinct("category_id").alias("b"))
    got = trending.select("region", "trending_date_parsed", "unique_channels", "unique_categories")
    assert got.exceptAll(plain).isEmpty()


def test_counts_of_all_null_columns_are_zero(spark):
    rows = spark.sql("select 'v' as video_id, 'us' as region, cast(null as date) as trending_date_parsed, "
                     "cast(null as string) as channel_title, cast(null as bigint) as category_id, 0L as views, 0L as likes, "
                     "0L as dislikes, 0L as comment_count, 0.0D as like_ratio, 0.0D as engagement_rate")
    t = gold.trending_analytics(rows).first()
    assert (t.unique_channels, t.unique_categories, t.total_videos) == (0, 0, 1)
    c = gold.channel_analytics(rows, None).first()
    assert (c.channel_title, c.total_videos, c.times_trending, c.categories, c.rank_in_region) == (None, 1, 0, ["Unknown"], 1)
    assert gold.category_analytics(rows, None).first().view_share_pct is None


def test_sum_overflow_raises(spark):
    rows = spark.sql("select 'v' as video_id, 'us' as region, date'2024-01-01' as trending_date_parsed, 'c' as channel_title, "
                     "1L as category_id, 9223372036854775807L as views, 0L as likes, 0L as dislikes, 0L as comment_count, "
                     "0.0D as like_ratio, 0.0D as engagement_rate from range(2)")
    with pytest.raises(Exception, match="OVERFLOW"):
        gold.trending_analytics(rows).collect()
