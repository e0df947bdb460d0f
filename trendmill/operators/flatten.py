"""Nested API payloads to flat rows. Input: one row per region and call, the payload as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmill import functions as fn
from trendmill.schemas import CATEGORY_PAYLOAD, CORRUPT, VIDEO_PAYLOAD

DEFAULT_SOURCE = "video_data_api"
_COUNTABLE = f"items array<string>, `{CORRUPT}` string"


def _items(payloads: DataFrame, schema) -> DataFrame:
    return payloads.select(
        fn.normalize_region(F.col("region")).alias("region"),
        F.col("_ingested_at").cast("string").alias("_ingested_at"),
        F.explode(F.from_json("payload", schema)["items"]).alias("item"),
    )


def flatten_videos(payloads: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """One row per video item.

    Counters that are absent or no whole number are 0, and so is the category id. A flag is set when the
    counter's key is absent from the statistics; a key that is present with null leaves it unset.
    Dislikes are no longer published and always 0.
    """
    counters = F.coalesce(F.col("item.statistics"), F.create_map().cast("map<string,string>"))

    def absent(key: str) -> Column:
        return ~F.map_contains_key(counters, key)

    return _items(payloads, VIDEO_PAYLOAD).select(
        F.col("item.id").alias("video_id"),
        F.col("item.snippet.title").alias("title"),
        F.col("item.snippet.channelId").alias("channel_id"),
        F.col("item.snippet.channelTitle").alias("channel_title"),
        fn.api_int(F.col("item.snippet.categoryId")).alias("category_id"),
        F.col("item.snippet.publishedAt").alias("publish_time"),
        fn.pipe_join(F.col("item.snippet.tags")).alias("tags"),
        fn.api_int(counters["viewCount"]).alias("views"),
        fn.api_int(counters["likeCount"]).alias("likes"),
        F.lit(0).cast("bigint").alias("dislikes"),
        fn.api_int(counters["commentCount"]).alias("comment_count"),
        absent("commentCount").alias("comments_disabled"),
        absent("likeCount").alias("ratings_disabled"),
        "region",
        "_ingested_at",
        F.lit(source).alias("_source"),
    )


def flatten_categories(payloads: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """One row per category item; an id that is not all digits is null."""
    return _items(payloads, CATEGORY_PAYLOAD).select(
        fn.digits_to_long(F.col("item.id")).alias("category_id"),
        F.col("item.snippet.title").alias("category_name"),
        "region",
        "_ingested_at",
        F.lit(source).alias("_source"),
    )


def payload_summary(payloads: DataFrame) -> DataFrame:
    """Per region: payloads that can be read, payloads that cannot, and the items they hold."""
    parsed = F.from_json("payload", _COUNTABLE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    read = payloads.select(fn.normalize_region(F.col("region")).alias("region"), "payload", parsed.alias("p"))
    good = F.col("payload").isNotNull() & F.col(f"p.{CORRUPT}").isNull()
    return read.groupBy("region").agg(
        F.count_if(good).alias("payloads_ok"),
        F.count_if(~good).alias("payloads_bad"),
        F.coalesce(F.sum(F.when(good, F.coalesce(F.size("p.items"), F.lit(0)))), F.lit(0)).cast("bigint").alias("items"),
    ).withColumn("succeeded", F.col("payloads_bad") == 0)
