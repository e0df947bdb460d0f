"""Readers, writers and flattening: the given tables are written as raw files and read back.

The work grows with the tables: every row is written and every row is read.
"""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from trendmill.operators.audit import counted, ingest_summary
from trendmill.operators.cleanse import cleanse_backfill
from trendmill.operators.dedup import latest_statistics
from trendmill.operators.flatten import flatten_categories, flatten_videos
from trendmill.operators.gold import category_analytics, stamp_aggregated
from trendmill.schemas import FLAT_VIDEO
from trendmill.session import fresh_path, settings, use_job_settings
from trendmill.sources.bronze_csv import read_backfill, read_backfill_groups, read_staged, region_from_path, stage_history
from trendmill.sources.bronze_json import GZIP_FILES, read_live, read_reference, write_bronze
from trendmill.sources.tables import overwrite_partitions, write_full
from trendmill.workload.gold_cases import SQL as GOLD_SQL
from trendmill.workload.silver_cases import RAW_BACKFILL
from trendmill.workload.tables import STATS_SQL, fresh_layout, lookup, over, portable, silver

INGESTED_AT = "2024-02-03T04:05:06+00:00"
_K = "get_json_object(props, '$.k')"
_K_SQL = "json_extract_string(props, '$.k')"


def write_csv(rows, path, *partition_by, rows_per_file=0):
    """CSV files of at most ``rows_per_file`` rows (0: any number). Those of some regions are written side by side, unsorted."""
    with settings(rows.sparkSession, spark__sql__maxConcurrentOutputFileWriters=16):
        (
            rows.write.partitionBy(*partition_by).option("header", "true").option("quote", '"').option("escape", '"')
            .option("maxRecordsPerFile", rows_per_file)
            .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
        )


def _documents_csv(spark, sf_dir):
    """Documents as backfill files; the whole text is the description, line breaks and quotes included."""
    rows = over(spark, sf_dir, """
        select cast(doc_id as string) as video_id, source as title, cast(n_chars as string) as views,
               'unused' as thumbnail_link, text as description, upper(lang) as region
        from {documents}""", "documents")
    path = fresh_path(spark, "csv")
    write_csv(rows, path, "region")
    return path


def _csv_scan(spark, sf_dir):
    return read_backfill(spark, _documents_csv(spark, sf_dir)).select(
        "video_id", "title", "views", "description", "region")


def _csv_split_scan(spark, sf_dir):
    """The same history staged once, in files of few rows, and read from there in many pieces."""
    staged = fresh_path(spark, "staged")
    stage_history(spark, _documents_csv(spark, sf_dir), staged, rows_per_file=100)
    rows = read_staged(spark, staged)
    files = rows.select("region", F.col("_metadata.file_path").alias("file")).groupBy("region").agg(
        F.count_distinct("file").alias("files"), F.count("*").alias("n"))
    if not files.filter("n > 100 and files < 2").isEmpty():
        raise AssertionError("a region is one piece")
    return rows.select("video_id", "title", "views", "description", "region")


def _csv_groups(spark, sf_dir):
    """Two sources with different headers, joined by column name."""
    first, second = fresh_path(spark, "csv"), fresh_path(spark, "csv")
    write_csv(over(spark, sf_dir, "select cast(o_orderkey as string) as video_id, o_orderpriority as title, "
                                   "lower(o_orderstatus) as region from {orders}", "orders"), first, "region")
    write_csv(over(spark, sf_dir, "select event_type as title, cast(event_id as string) as video_id, "
                                   "cast(value as string) as views, event_type as region from {events}", "events"),
               second, "region")
    return read_backfill_groups(spark, [first, second]).select("video_id", "title", "views", "region")


def _region_from_path(spark, sf_dir):
    path = fresh_path(spark, "csv")
    write_csv(over(spark, sf_dir, "select o_orderkey, o_custkey, o_orderstatus as region from {orders}", "orders"),
               path, "region")
    found = region_from_path(spark.read.options(header="true", recursiveFileLookup="true").csv(path))
    return found.groupBy("region").agg(
        F.count("*").alias("n"), F.sum(F.col("o_custkey").cast("bigint")).alias("custkeys"))


# Numbers in a line come bare, quoted, fractional or as junk.
_LINES = rf"""
    select case when event_type = 'error' and value < 250 then concat('{{{{"video_id": "', cast(event_id as string))
                else concat('{{{{"video_id": "', cast(event_id as string), '", "title": "é|', event_type,
                            '", "views": ', case when user_id % 4 = 0 then concat('"', {_K}, '"')
                                                when user_id % 4 = 1 then '1.5' when user_id % 4 = 2 then '"x"'
                                                else {_K} end,
                            ', "region": "XX", "category_id": ', {_K}, ', "comments_disabled": true}}}}') end as line,
           event_type as region, date_format(ts, 'yyyy-MM-dd') as date
    from {{events}}
"""
_VIEWS_TEXT = f"""case user_id % 4 when 0 then {_K_SQL} when 1 then '1.5' when 2 then 'x' else {_K_SQL} end"""


def write_lines(spark, sf_dir, *partition_by):
    """JSON lines, some of them broken, as text files below region= (and date=) folders."""
    path = fresh_path(spark, "lines")
    rows = over(spark, sf_dir, _LINES, "events").select("line", *partition_by)
    rows.repartition(*[F.col(c) for c in partition_by]).write.partitionBy(*partition_by).text(path)
    return path


def _live_scan(spark, sf_dir):
    rows = read_live(spark, write_lines(spark, sf_dir, "region"), files="*.txt")
    return rows.filter(F.col("video_id").isNotNull()).select(
        "video_id", "title", "views", "category_id", "comments_disabled", "region", "channel_id")


def _whole_files(spark, sf_dir):
    rows = read_live(spark, write_lines(spark, sf_dir, "region", "date"), on_bad_record="drop_file", files="*.txt")
    return rows.select("video_id", "title", "views", "region")


def _ingest_audit(spark, sf_dir):
    return ingest_summary(read_live(spark, write_lines(spark, sf_dir, "region"), keep_corrupt=True, files="*.txt"))


def _reference_scan(spark, sf_dir):
    path = fresh_path(spark, "reference")
    rows = over(spark, sf_dir, """
        select p_partkey as category_id, p_name as category_name, lower(p_brand) as region, 'made' as _source from {part}
    """, "part").withColumn("region", F.regexp_replace("region", "#", "_"))
    write_bronze(rows, path, INGESTED_AT, hourly=False)
    return read_reference(spark, path)


_VIDEO_PAYLOADS = f"""
    select event_type as region, '{INGESTED_AT}' as _ingested_at, concat(
        '{{{{"items": [{{{{"id": "', event_id, '", "snippet": {{{{"title": "t', user_id, '", "channelId": "c", "channelTitle": "',
        event_type, '", "categoryId": "', {_K}, '", "publishedAt": "p", "tags": ',
        case user_id % 3 when 0 then '["a", "b"]' when 1 then '[]' else 'null' end, '}}}}, "statistics": {{{{',
        case user_id % 4 when 0 then concat('"viewCount": "', {_K}, '", "likeCount": "7"')
                         when 1 then '"likeCount": null, "commentCount": "1.5"'
                         when 2 then concat('"viewCount": "x", "commentCount": "', event_id, '"')
                         else '' end,
        '}}}}}}}}, {{{{"id": "n', event_id, '"}}}}]}}}}') as payload
    from {{events}}
"""
_CATEGORY_PAYLOADS = """
    select lower(p_type) as region, '2024-02-03' as _ingested_at, concat(
        '{{"items": [{{"id": "', case when p_size < 10 then 'x' else '' end, p_partkey, '", "snippet": {{"title": "',
        p_name, '"}}}}, {{"id": "', p_size, ' "}}]}}') as payload
    from {part}
"""


def _bronze_rewrite(spark, sf_dir):
    """A run that is repeated, the first time with other rows and a region too many; and the same for daily files."""
    live, names = fresh_path(spark, "live"), fresh_path(spark, "reference")
    videos = flatten_videos(over(spark, sf_dir, _VIDEO_PAYLOADS, "events"), "made")
    names_of = over(spark, sf_dir, "select user_id as category_id, event_type as category_name, event_type as region, "
                                   "'made' as _source from {events}", "events")
    first = videos.union(videos.withColumn("region", F.lit("elsewhere")))
    for rows, other in ((first, names_of.withColumn("category_name", F.lit("old"))), (videos, names_of)):
        write_bronze(rows, live, INGESTED_AT, compression="gzip")
        write_bronze(other, names, INGESTED_AT, hourly=False, compression="gzip")
    write_bronze(videos.filter("views > 0"), live, INGESTED_AT, run_id="another run of the hour", compression="gzip")
    return read_live(spark, live, files=GZIP_FILES).select(F.lit("live").alias("kind"), "region", "video_id", "views").unionByName(
        read_reference(spark, names, files=GZIP_FILES).select(
            F.lit("names").alias("kind"), "region", F.col("category_id").alias("video_id"), F.col("category_name").alias("views")))


def _bronze_write(spark, sf_dir):
    path = fresh_path(spark, "live")
    write_bronze(flatten_videos(over(spark, sf_dir, _VIDEO_PAYLOADS, "events")), path, INGESTED_AT)
    raw = spark.read.json(path, schema=FLAT_VIDEO.add("date", "string").add("hour", "string").add("run", "string"))
    return raw.select("video_id", "title", "category_id", "views", "tags", "ratings_disabled", "region", "date", "hour")


# --- tables -----------------------------------------------------------------------------------------


def _silver_roundtrip(spark, sf_dir):
    layout = fresh_layout(spark)
    write_full(silver(spark, sf_dir), layout.statistics, layout.path("clean_statistics"))
    return portable(spark.table(layout.statistics))


def _partition_overwrite(spark, sf_dir):
    layout = fresh_layout(spark)
    where = layout.table("orders"), layout.path("orders")
    rows = over(spark, sf_dir, "select o_orderkey, o_custkey, lower(o_orderstatus) as region from {orders}", "orders")
    overwrite_partitions(rows, *where)
    overwrite_partitions(rows.filter("region = 'f'").withColumn("o_custkey", -F.col("o_custkey"))
                         .withColumn("added", F.lit("new")), *where)
    return spark.table(where[0])


def _gold_roundtrip(spark, sf_dir):
    layout = fresh_layout(spark)
    rows = stamp_aggregated(category_analytics(silver(spark, sf_dir), lookup(spark, sf_dir)))
    for _ in range(2):  # a re-run replaces the table
        write_full(rows, layout.table("category_analytics"), layout.path("category_analytics"))
    return portable(spark.table(layout.table("category_analytics")).drop("_aggregated_at"))


def _cleanse_audit(spark, sf_dir):
    """Counts of one cleaning run, taken while the rows are written."""
    read, kept, unique = Observation(), Observation(), Observation()
    raw = counted(over(spark, sf_dir, RAW_BACKFILL, "lineitem"), read)
    landed, out = fresh_path(spark, "landed"), fresh_path(spark, "silver")
    rows = cleanse_backfill(raw, "backfill")
    counted(rows, kept).write.parquet(landed)
    counted(latest_statistics(spark.read.schema(rows.schema).parquet(landed)), unique).write.parquet(out)
    counts = (read.get["rows"], kept.get["rows"], unique.get["rows"])
    return spark.createDataFrame(
        [(*counts, counts[0] - counts[2])], "rows_read bigint, rows_landed bigint, rows_silver bigint, rows_removed bigint")


QUERIES = {
    "bronze_csv_scan": _csv_scan,
    "bronze_csv_split_scan": _csv_split_scan,
    "bronze_csv_groups": _csv_groups,
    "bronze_region_from_path": _region_from_path,
    "bronze_live_jsonl_scan": _live_scan,
    "bronze_reference_jsonl_scan": _reference_scan,
    "bad_file_quarantine": _whole_files,
    "ingest_audit": _ingest_audit,
    "flatten_videos": lambda s, d: flatten_videos(over(s, d, _VIDEO_PAYLOADS, "events"), "made"),
    "flatten_categories": lambda s, d: flatten_categories(over(s, d, _CATEGORY_PAYLOADS, "part"), "made"),
    "bronze_jsonl_write": _bronze_write,
    "bronze_rewrite": _bronze_rewrite,
    "silver_roundtrip": _silver_roundtrip,
    "partition_overwrite": _partition_overwrite,
    "gold_roundtrip": _gold_roundtrip,
    "cleanse_audit": _cleanse_audit,
}

_FLAT_VIDEOS = f"""
    select cast(event_id as varchar) as video_id, 't' || user_id as title, 'c' as channel_id, event_type as channel_title,
           cast({_K_SQL} as bigint) as category_id, 'p' as publish_time,
           case when user_id % 3 = 0 then 'a|b' end as tags,
           case when user_id % 4 = 0 then cast({_K_SQL} as bigint) else 0 end as views,
           case when user_id % 4 = 0 then 7 else 0 end as likes,
           0 as dislikes,
           case when user_id % 4 = 2 then event_id else 0 end as comment_count,
           user_id % 4 in (0, 3) as comments_disabled,
           user_id % 4 in (2, 3) as ratings_disabled,
           event_type as region, '{INGESTED_AT}' as _ingested_at, 'made' as _source
    from events
    union all
    select 'n' || event_id, null, null, null, 0, null, null, 0, 0, 0, 0, true, true, event_type, '{INGESTED_AT}', 'made'
    from events
"""

_DOCUMENTS = """
    select cast(doc_id as varchar) as video_id, source as title, cast(n_chars as varchar) as views,
           text as description, upper(lang) as region
    from documents
"""

SQL = {
    "bronze_csv_scan": _DOCUMENTS,
    "bronze_csv_split_scan": _DOCUMENTS,
    "bronze_csv_groups": """
        select cast(o_orderkey as varchar) as video_id, o_orderpriority as title, cast(null as varchar) as views,
               lower(o_orderstatus) as region from orders
        union all
        select cast(event_id as varchar), event_type, cast(value as varchar), event_type from events
    """,
    "bronze_region_from_path": """
        select o_orderstatus as region, count(*) as n, cast(sum(o_custkey) as bigint) as custkeys
        from orders group by o_orderstatus
    """,
    "bronze_live_jsonl_scan": f"""
        select cast(event_id as varchar) as video_id, 'é|' || event_type as title, {_VIEWS_TEXT} as views,
               {_K_SQL} as category_id, 'true' as comments_disabled, event_type as region,
               cast(null as varchar) as channel_id
        from events where not (event_type = 'error' and value < 250)
    """,
    "bronze_reference_jsonl_scan": f"""
        select cast(p_partkey as varchar) as category_id, p_name as category_name,
               replace(lower(p_brand), '#', '_') as region, cast(null as varchar) as _ingested_at, 'made' as _source
        from part
    """,
    "bad_file_quarantine": f"""
        select cast(event_id as varchar) as video_id, 'é|' || event_type as title, {_VIEWS_TEXT} as views,
               event_type as region
        from events e where not exists (
            select 1 from events b where b.event_type = 'error' and b.value < 250
                                     and b.event_type = e.event_type and cast(b.ts as date) = cast(e.ts as date))
    """,
    "ingest_audit": """
        select event_type as region, count(*) filter (where not (event_type = 'error' and value < 250)) as rows_ok,
               count(*) filter (where event_type = 'error' and value < 250) as rows_bad,
               count(*) filter (where not (event_type = 'error' and value < 250)) as rows_with_id,
               count(*) filter (where event_type = 'error' and value < 250) = 0 as succeeded
        from events group by event_type
    """,
    "flatten_videos": _FLAT_VIDEOS,
    "flatten_categories": """
        select case when p_size < 10 then null else p_partkey end as category_id, p_name as category_name,
               lower(p_type) as region, '2024-02-03' as _ingested_at, 'made' as _source
        from part
        union all
        select null, null, lower(p_type), '2024-02-03', 'made' from part
    """,
    "bronze_jsonl_write": f"""
        select video_id, title, category_id, views, tags, ratings_disabled, region, '2024-02-03' as date, '04' as hour
        from ({_FLAT_VIDEOS})
    """,
    "bronze_rewrite": f"""
        select 'live' as kind, region, video_id, cast(views as varchar) as views from ({_FLAT_VIDEOS})
        union all
        select 'live', region, video_id, cast(views as varchar) from ({_FLAT_VIDEOS}) where views > 0
        union all
        select 'names', event_type, cast(user_id as varchar), event_type from events
    """,
    "silver_roundtrip": f"""
        select * replace (cast(trending_date_parsed as varchar) as trending_date_parsed) from ({STATS_SQL})
    """,
    "partition_overwrite": """
        select o_orderkey, case when o_orderstatus = 'F' then -o_custkey else o_custkey end as o_custkey,
               lower(o_orderstatus) as region, case when o_orderstatus = 'F' then 'new' end as added
        from orders
    """,
    "gold_roundtrip": GOLD_SQL["gold_category"],
    "cleanse_audit": """
        with typed as (
            select l_partkey, l_linestatus,
                   case l_returnflag
                       when 'A' then make_date(2000 + year(l_shipdate) % 100, month(l_shipdate), day(l_shipdate))
                       when 'N' then cast(l_shipdate as date) end as day
            from lineitem where not (l_returnflag = 'R' and l_linenumber = 6)
        ), counts as (
            select (select count(*) from lineitem) as rows_read, (select count(*) from typed) as rows_landed,
                   (select count(*) from (select distinct * from typed)) as rows_silver
        )
        select *, rows_read - rows_silver as rows_removed from counts
    """,
}
