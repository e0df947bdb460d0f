"""Plan shapes that decide how the jobs scale."""

import pytest
from pyspark.sql import functions as F

from trendmill.operators import gold
from trendmill.operators.reference import measured_lookup
from trendmill.plans import reports
from trendmill.session import folder_bytes, initial_partitions
from trendmill.sources.tables import write_full


def plan(df):
    spark = df.sparkSession
    return df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture
def stats(spark, layout):
    rows = spark.range(1000).selectExpr(
        "cast(id % 97 as string) as video_id", "if(id % 3 = 0, 'us', 'gb') as region",
        "date_add(date'2024-01-01', cast(id % 5 as int)) as trending_date_parsed", "concat('c', id % 13) as channel_title",
        "id % 7 as category_id", "id as views", "id as likes", "0L as dislikes", "id as comment_count",
        "0.5D as like_ratio", "0.25D as engagement_rate", "repeat('x', 100) as tags")
    write_full(rows, layout.statistics, layout.path("clean_statistics"))
    return spark.table(layout.statistics)


@pytest.fixture
def lookup(spark):
    return measured_lookup(spark.createDataFrame([(1, "One", "us")], "category_id long, category_name string, region string"))


def test_gold_reads_only_its_columns_and_partitions(stats):
    text = plan(gold.trending_analytics(stats.filter("region = 'us'")))
    assert "tags" not in text and "PartitionFilters: [isnotnull(region" in text
    assert "Expand" not in text


def test_gold_has_no_row_level_join_and_no_window_over_a_region(stats, lookup):
    channel, category = plan(gold.channel_totals(stats, lookup)), plan(gold.category_analytics(stats, lookup))
    for text in (channel, category):
        assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
        assert "Expand" not in text
    assert "Window" not in channel
    assert "PythonUDF" not in channel + category and "ArrowEvalPython" not in channel + category


def test_report_prunes_partitions_and_keeps_top_rows_only(spark, layout, stats, lookup):
    write_full(gold.channel_analytics(stats, lookup), layout.table("channel_analytics"), layout.path("channel_analytics"))
    text = plan(reports.top_channels(spark.table(layout.table("channel_analytics")), "us"))
    assert "TakeOrderedAndProject" in text and "PartitionFilters: [isnotnull(region" in text
    assert [r.rank_in_region for r in reports.top_channels(
        spark.table(layout.table("channel_analytics")), "us", limit=3).collect()] == [1, 2, 3]


def test_large_lookup_is_joined_by_shuffle(spark, stats, monkeypatch):
    from trendmill.operators import broadcasting, reference
    monkeypatch.setattr(reference, "broadcast_if_small", lambda df: broadcasting.broadcast_if_small(df, max_rows=0))
    names = spark.createDataFrame([(i, f"n{i}", "us") for i in range(5)], "category_id long, category_name string, region string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = reference.measured_lookup(names)
        rows = gold.category_analytics(stats, big)
        assert "BroadcastHashJoin" not in plan(rows)
        assert rows.filter(F.col("category_name") == "Unknown").select("category_id").distinct().count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_job_sizes_its_shuffles_by_its_input(spark, layout, stats, monkeypatch):
    from trendmill.plans import pipeline

    key, seen = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", []
    monkeypatch.setattr(pipeline, "folder_bytes", lambda *_: 10**11)
    for name, done in (("write_version", lambda *_: seen.append(spark.conf.get(key))), ("point_to", lambda *_: None),
                       ("remove_old_versions", lambda *_: None)):
        monkeypatch.setattr(pipeline, name, done)
    before = spark.conf.get(key, None)
    pipeline.build_gold(spark, layout)
    assert seen == ["373"] * 3 and spark.conf.get(key, None) == before
    assert folder_bytes(spark, layout.path("clean_statistics")) > 1000
    assert folder_bytes(spark, layout.path("nothing")) == 0


def test_partitions_grow_with_the_input():
    assert [initial_partitions(n) for n in (0, 10**9, 10**12, 10**14)] == [200, 200, 3726, 372_530]
