"""One StructType per layer; readers, writers and tests all use these."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def all_strings(names: list[str] | tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


CORRUPT = "_corrupt_record"

# Columns the backfill keeps from the CSV files, before the path adds region.
BACKFILL_COLUMNS = (
    "video_id", "trending_date", "title", "channel_title", "category_id", "publish_time", "tags",
    "views", "likes", "dislikes", "comment_count", "comments_disabled", "ratings_disabled",
)

# Every scalar of a JSON line is read as text: one bad number must not spoil its whole row.
LIVE_FIELDS = (
    "video_id", "title", "channel_id", "channel_title", "category_id", "publish_time", "tags",
    "views", "likes", "dislikes", "comment_count", "comments_disabled", "ratings_disabled",
    "region", "_ingested_at", "_source",
)
REFERENCE_FIELDS = ("category_id", "category_name", "region", "_ingested_at", "_source")

VIDEO_PAYLOAD = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("snippet", T.StructType([
            T.StructField("title", T.StringType()),
            T.StructField("channelId", T.StringType()),
            T.StructField("channelTitle", T.StringType()),
            T.StructField("categoryId", T.StringType()),
            T.StructField("publishedAt", T.StringType()),
            T.StructField("tags", T.ArrayType(T.StringType())),
        ])),
        # A map, not a struct: whether a counter's key is present carries meaning.
        T.StructField("statistics", T.MapType(T.StringType(), T.StringType())),
    ]))),
])
CATEGORY_PAYLOAD = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("snippet", T.StructType([T.StructField("title", T.StringType())])),
    ]))),
])

FLAT_VIDEO = _struct(
    video_id=T.StringType(), title=T.StringType(), channel_id=T.StringType(), channel_title=T.StringType(),
    category_id=T.LongType(), publish_time=T.StringType(), tags=T.StringType(), views=T.LongType(),
    likes=T.LongType(), dislikes=T.LongType(), comment_count=T.LongType(), comments_disabled=T.BooleanType(),
    ratings_disabled=T.BooleanType(), region=T.StringType(), _ingested_at=T.StringType(), _source=T.StringType(),
)
FLAT_CATEGORY = _struct(
    category_id=T.LongType(), category_name=T.StringType(), region=T.StringType(),
    _ingested_at=T.StringType(), _source=T.StringType(),
)

STATISTICS = _struct(
    video_id=T.StringType(), trending_date=T.StringType(), title=T.StringType(), channel_title=T.StringType(),
    category_id=T.LongType(), publish_time=T.StringType(), tags=T.StringType(), views=T.LongType(),
    likes=T.LongType(), dislikes=T.LongType(), comment_count=T.LongType(), comments_disabled=T.BooleanType(),
    ratings_disabled=T.BooleanType(), trending_date_parsed=T.DateType(), like_ratio=T.DoubleType(),
    engagement_rate=T.DoubleType(), _processed_at=T.TimestampType(), _job_name=T.StringType(),
    region=T.StringType(),
)
STATISTICS_KEY = ("video_id", "region", "trending_date_parsed")

REFERENCE = _struct(
    category_id=T.LongType(), category_name=T.StringType(), _processed_at=T.TimestampType(), region=T.StringType(),
)
REFERENCE_KEY = ("region", "category_id")

# Landing keeps every cleaned row that ever arrived, with the time its source gave it. A batch has one folder, its
# months lie below; the catalog finds a month's folders in any order of the levels.
SILVER_PARTITIONS = ("region", "trending_month")
LANDING_PARTITIONS = ("feed", "batch_id", *SILVER_PARTITIONS)
LANDING = T.StructType(
    [f for f in STATISTICS.fields if f.name != "region"]
    + [
        T.StructField("_source_time", T.TimestampType(), True),
        # Where a row came from: the file (backfill only) and the batch it first landed in, which folding keeps.
        T.StructField("source_file", T.StringType(), True),
        T.StructField("origin_batch", T.LongType(), True),
        T.StructField("feed", T.StringType(), True),
        T.StructField("batch_id", T.LongType(), True),
        T.StructField("region", T.StringType(), True),
        T.StructField("trending_month", T.StringType(), True),
    ]
)

# One row per version of a source file that has landed: what it was and which partitions its rows are in.
FILES_PARTITIONS = ("feed", "batch_id")
LANDED_FILES = T.StructType([
    T.StructField("file", T.StringType(), True),
    T.StructField("size", T.LongType(), True),
    T.StructField("modified", T.TimestampType(), True),
    T.StructField("rows", T.LongType(), True),
    T.StructField("partitions", T.ArrayType(_struct(region=T.StringType(), trending_month=T.StringType())), True),
    T.StructField("feed", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), True),
])

CHECK = T.StructType([
    T.StructField("check", T.StringType(), False),
    T.StructField("table", T.StringType(), False),
    T.StructField("column", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("threshold", T.DoubleType(), True),
    T.StructField("negative", T.LongType(), True),
    T.StructField("extreme", T.LongType(), True),
    T.StructField("missing", T.ArrayType(T.StringType()), True),
    T.StructField("latest", T.TimestampType(), True),
    T.StructField("passed", T.BooleanType(), True),
    T.StructField("message", T.StringType(), True),
])
