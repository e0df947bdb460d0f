"""Category names: cleaning, lookup and join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmill import functions as fn
from trendmill.operators.broadcasting import broadcast_if_small
from trendmill.operators.cleanse import column_or_null
from trendmill.operators.dedup import latest_reference
from trendmill.schemas import REFERENCE

UNKNOWN = "Unknown"


def clean_reference(raw: DataFrame) -> DataFrame:
    """Typed ids, null ids dropped, newest name per (region, category_id)."""
    rows = raw.select(
        fn.to_long(column_or_null(raw, "category_id")).alias("category_id"),
        column_or_null(raw, "category_name").alias("category_name"),
        fn.normalize_region(column_or_null(raw, "region")).alias("region"),
        fn.utc_timestamp(column_or_null(raw, "_ingested_at")).alias("_source_time"),
    ).filter(F.col("category_id").isNotNull())
    return latest_reference(rows).withColumn("_processed_at", F.current_timestamp()).select(*REFERENCE.fieldNames())


def category_lookup(reference: DataFrame) -> DataFrame | None:
    """One name per category id across all regions: the name of the first region that has one.

    None if the table lacks the needed columns; ``enrich_category`` then names everything 'Unknown'.
    """
    if not {"category_id", "category_name"} <= set(reference.columns):
        return None
    region = F.col("region") if "region" in reference.columns else F.lit(None).cast("string")
    return (
        reference.select(F.col("category_id").try_cast("bigint").alias("category_id"), "category_name",
                         region.alias("region"))
        .filter(F.col("category_id").isNotNull() & F.col("category_name").isNotNull())
        .groupBy("category_id")
        .agg(F.min(F.struct(F.coalesce("region", F.lit("")).alias("region"), "category_name")).alias("first"))
        .select("category_id", F.col("first.category_name").alias("category_name"))
    )


def measured_lookup(reference: DataFrame) -> DataFrame | None:
    """The lookup, marked for broadcast if its measured size allows."""
    lookup = category_lookup(reference)
    return None if lookup is None else broadcast_if_small(lookup)


def enrich_category(df: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Add category_name by left join; unmatched and null ids, or a missing lookup, give 'Unknown'."""
    if lookup is None:
        return df.withColumn("category_name", F.lit(UNKNOWN))
    named = df.withColumn("category_id", F.col("category_id").cast("bigint")).join(lookup, "category_id", "left")
    return named.fillna(UNKNOWN, subset=["category_name"])
