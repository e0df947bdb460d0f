"""Test tables and raw files are built so that they scale: pieces of bounded size, joins alike at every size."""

import pytest
from pyspark.sql import functions as F

from trendmill.operators import gold
from trendmill.session import folder_names
from trendmill.workload import pipeline_cases, tables


def test_files_of_a_history_are_many_and_corrected_in_place(spark, tmp_path):
    right = spark.range(200).select(
        F.col("id").cast("string").alias("video_id"), F.lit("24.01.02").alias("trending_date"), F.lit("5").alias("views"))
    wrong = right.withColumns({"views": F.lit("999"), "trending_date": F.lit("31.01.01")})
    folder = str(tmp_path / "region=us")
    assert pipeline_cases._files(spark, wrong, folder, 4) == 4
    names = folder_names(spark, f"{folder}/*.csv")
    assert pipeline_cases._files(spark, right, folder, 4) == 4
    assert folder_names(spark, f"{folder}/*.csv") == names
    read = spark.read.option("header", "true").csv(folder)
    assert read.count() == 200 and read.filter("views <> '5' or trending_date <> '24.01.02'").isEmpty()


@pytest.fixture
def star(spark, tmp_path):
    """Seven order lines with null and unknown keys, an order that comes twice, and their tables."""
    def save(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))

    save("region", [(0, " ASIA ")], "r_regionkey int, r_name string")
    save("nation", [(1, 0)], "n_nationkey int, n_regionkey int")
    save("customer", [(1, 1), (2, None), (None, 1)], "c_custkey bigint, c_nationkey int")
    save("supplier", [(1, "s1", 7), (1, "s1", 7)], "s_suppkey bigint, s_name string, s_nationkey int")
    save("orders", [(1, 1, "2024-01-02"), (1, 1, "2024-01-03"), (2, 2, "2024-01-02"), (None, 1, "2024-01-02"), (3, None, None)],
         "o_orderkey bigint, o_custkey bigint, o_orderdate string")
    save("lineitem", [(1, 5, 1, 1, 10.6, 2.0, 0.05), (1, 6, 1, 7, 10.0, 2.0, None), (2, 5, 1, 1, 1.0, 1.0, 0.0),
                      (None, 5, 1, 1, 1.0, 1.0, 0.0), (3, 5, 1, 1, 1.0, 1.0, 0.0), (1, 5, None, 1, 1.0, 1.0, 0.0),
                      (1, 5, 9, 1, 1.0, 1.0, 0.0)],
         "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_quantity double, "
         "l_tax double")
    return str(tmp_path)


def test_facts_are_those_of_the_sql_and_move_order_lines_once(spark, star):
    rows = tables.facts(spark, star)
    frames = {name: spark.read.parquet(f"{star}/{name}.parquet") for name in tables._FACT_TABLES}
    want = spark.sql(tables._FACT.replace("{text}", "string"), **frames)
    assert rows.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, rows.collect())) == sorted(map(str, want.collect())) and rows.count() == 8
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and "SortMergeJoin [l_orderkey" in plan


def test_category_groups_count_channels_apart_from_the_sums(spark):
    rows = spark.sql("""
        select * from values (1L, 'us', 'v', 'a', 5L), (1L, 'us', 'w', 'a', 7L), (1L, 'us', 'w', null, 1L), (null, null, 'v', null, 2L)
            as t(category_id, region, video_id, channel_title, views)
    """).withColumns({"likes": F.lit(1).cast("bigint"), "comment_count": F.lit(1).cast("bigint"), "engagement_rate": F.lit(1.5),
                      "trending_date_parsed": F.lit("2024-01-02").cast("date")})
    groups = gold.category_groups(rows)
    assert sorted((str(r.category_id), r.video_count, r.total_views, r.unique_channels) for r in groups.collect()) == [
        ("1", 3, 13, 1), ("None", 1, 2, 0)]
    by_channel = [line for line in groups._jdf.queryExecution().sparkPlan().toString().splitlines()
                  if "Aggregate" in line and "channel_title" in line]
    assert by_channel and not any("sum(" in line for line in by_channel)
