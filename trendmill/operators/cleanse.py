"""Bronze to Silver for statistics rows: casts, filters, fills, metrics, provenance."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmill import functions as fn
from trendmill.schemas import BACKFILL_COLUMNS, STATISTICS

METRICS = ("views", "likes", "dislikes", "comment_count")


def column_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def align_columns(df: DataFrame, schema) -> DataFrame:
    """Exactly the schema's columns, in its order; a column ``df`` lacks becomes a typed null."""
    return df.select([
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def enforce_backfill_types(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 14 backfill columns with their types, and the columns ``keep`` as they are.

    A value that does not fit its type becomes null.
    """
    text = {name: column_or_null(raw, name).cast("string") for name in (*BACKFILL_COLUMNS, "region")}
    longs = {"category_id", *METRICS}
    flags = {"comments_disabled", "ratings_disabled"}

    def typed(name: str) -> Column:
        if name in longs:
            return fn.to_long(text[name])
        if name in flags:
            return fn.to_boolean(text[name])
        return text[name]

    return raw.select(
        *[typed(name).alias(name) for name in BACKFILL_COLUMNS],
        fn.normalize_region(text["region"]).alias("region"),
        *keep,
    )


def enforce_live_types(raw: DataFrame, missing_category: int | None = 0) -> DataFrame:
    """Live rows (all text) as the 14 columns plus the ingestion time.

    Unparsable or missing numbers are 0. The category id follows the same rule, so that live rows group
    as they always did; pass ``missing_category=None`` to keep a missing id null as in the backfill.
    A missing flag is false. The snapshot date is the UTC day of ingestion; an unparsable time gives
    null, never today's date, so that a re-run gives the same rows.
    """
    get = lambda name: column_or_null(raw, name)
    source_time = fn.utc_timestamp(get("_ingested_at"))
    day = F.to_date(source_time)
    category = fn.to_long(get("category_id"))
    if missing_category is not None:
        category = F.coalesce(category, F.lit(missing_category).cast("bigint"))
    flag = lambda name: F.coalesce(fn.to_boolean(get(name)), F.lit(False))
    return raw.select(
        get("video_id").cast("string").alias("video_id"),
        F.date_format(day, "yyyy-MM-dd").alias("trending_date"),
        get("title").alias("title"),
        get("channel_title").alias("channel_title"),
        category.alias("category_id"),
        get("publish_time").alias("publish_time"),
        get("tags").alias("tags"),
        *[fn.to_long_or_zero(get(name)).alias(name) for name in METRICS],
        flag("comments_disabled").alias("comments_disabled"),
        flag("ratings_disabled").alias("ratings_disabled"),
        fn.normalize_region(get("region")).alias("region"),
        day.alias("trending_date_parsed"),
        source_time.alias("_source_time"),
    )


def drop_blank_ids(df: DataFrame) -> DataFrame:
    return df.filter(fn.has_text(F.col("video_id")))


def filter_regions(df: DataFrame, regions: Collection[str] | None = None) -> DataFrame:
    """Keep the named regions, or all of them (None). Case and outer blanks do not matter, in names and in rows."""
    if regions is None:
        return df
    asked = F.transform(F.array(*[F.lit(r) for r in regions]).cast("array<string>"), fn.normalize_region)
    return df.filter(F.array_contains(asked, fn.normalize_region(F.col("region"))))


def fill_metric_nulls(df: DataFrame) -> DataFrame:
    """Null counters become 0. The category id is not a counter and stays null."""
    return df.fillna(0, subset=list(METRICS))


def add_trending_date(df: DataFrame) -> DataFrame:
    return df.withColumn("trending_date_parsed", fn.parse_trending_date(F.col("trending_date")))


def add_rates(df: DataFrame) -> DataFrame:
    views, likes = F.col("views"), F.col("likes")
    return df.withColumns({
        "like_ratio": fn.like_ratio(likes, views),
        "engagement_rate": fn.engagement_rate(likes, F.col("dislikes"), F.col("comment_count"), views),
    })


def add_provenance(df: DataFrame, job_name: str) -> DataFrame:
    return df.withColumns({"_processed_at": F.current_timestamp(), "_job_name": F.lit(job_name)})


def cleanse_backfill(
    raw: DataFrame, job_name: str, regions: Collection[str] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Everything the backfill does before de-duplication; no shuffle. Columns ``keep`` of ``raw`` come last."""
    rows = drop_blank_ids(enforce_backfill_types(filter_regions(raw, regions), keep))
    rows = add_provenance(add_rates(fill_metric_nulls(add_trending_date(rows))), job_name)
    return align_columns(rows, T.StructType([*STATISTICS.fields, *[raw.schema[name] for name in keep]]))


def cleanse_live(raw: DataFrame, job_name: str, missing_category: int | None = 0) -> DataFrame:
    """Live rows in the Silver layout plus ``_source_time``; no shuffle."""
    rows = add_provenance(add_rates(drop_blank_ids(enforce_live_types(raw, missing_category))), job_name)
    return rows.select(*STATISTICS.fieldNames(), "_source_time")
