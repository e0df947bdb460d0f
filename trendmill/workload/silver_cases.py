"""Casts, filters, fills and de-duplication, over rows made messy on purpose."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmill import functions as fn
from trendmill.operators import cleanse, dedup
from trendmill.operators.reference import clean_reference
from trendmill.schemas import STATISTICS
from trendmill.workload.tables import RATES_SQL, STATS_SQL, facts, over, portable

# --- backfill rows as text, from order lines ------------------------------------------------------
RAW_BACKFILL = r"""
    select case when l_returnflag = 'R' and l_linenumber = 6 then ' ' else cast(l_partkey as string) end as video_id,
           case l_returnflag when 'A' then date_format(l_shipdate, 'yy.dd.MM')
                             when 'N' then date_format(l_shipdate, 'yyyy-MM-dd')
                             else '17.31.02' end as trending_date,
           concat(l_returnflag, l_linestatus) as title,
           concat('c', cast(l_suppkey as string)) as channel_title,
           case when l_linestatus = 'O' then '' else cast(l_suppkey as string) end as category_id,
           cast(null as string) as publish_time,
           'a|b' as tags,
           case l_linenumber when 1 then 'x' when 2 then cast(l_quantity as string) when 3 then null
                             when 4 then '99999999999999999999999'
                             else cast(cast(round(l_extendedprice) as bigint) as string) end as views,
           concat(' ', cast(cast(l_quantity as bigint) as string), ' ') as likes,
           '' as dislikes,
           cast(l_linenumber as string) as comment_count,
           case l_returnflag when 'A' then 'True' when 'N' then 'False' else 'maybe' end as comments_disabled,
           case l_linestatus when 'O' then 'TRUE' else null end as ratings_disabled,
           case l_linestatus when 'O' then ' US' else 'Gb ' end as region
    from {lineitem}
"""
_TYPED = """
    select case when l_returnflag = 'R' and l_linenumber = 6 then ' ' else cast(l_partkey as varchar) end as video_id,
           case l_returnflag
               when 'A' then strftime(l_shipdate, '%y.%d.%m')
               when 'N' then strftime(l_shipdate, '%Y-%m-%d') else '17.31.02' end as trending_date,
           l_returnflag || l_linestatus as title,
           'c' || l_suppkey as channel_title,
           case when l_linestatus = 'O' then null else l_suppkey end as category_id,
           cast(null as varchar) as publish_time,
           'a|b' as tags,
           case when l_linenumber = 2 then cast(l_quantity as bigint) when l_linenumber in (1, 3, 4) then null
                else cast(round(l_extendedprice) as bigint) end as views,
           cast(l_quantity as bigint) as likes,
           cast(null as bigint) as dislikes,
           cast(l_linenumber as bigint) as comment_count,
           case l_returnflag when 'A' then true when 'N' then false end as comments_disabled,
           case l_linestatus when 'O' then true end as ratings_disabled,
           case l_linestatus when 'O' then 'us' else 'gb' end as region,
           case l_returnflag
               when 'A' then make_date(2000 + year(l_shipdate) % 100, month(l_shipdate), day(l_shipdate))
               when 'N' then cast(l_shipdate as date) end as day
    from lineitem
"""

_OUT = [c for c in STATISTICS.fieldNames() if c not in ("_processed_at", "_job_name")]
_TIES = ", ".join(
    f"{c} desc nulls last" for c in _OUT if c not in ("video_id", "region", "trending_date_parsed")
)


def _latest_sql(rows: str, first: str = "") -> str:
    """One row per key in the documented order; ``rows`` has the _OUT columns (and those of ``first``)."""
    columns = ", ".join(_OUT).replace("trending_date_parsed", "cast(trending_date_parsed as varchar) as trending_date_parsed")
    return f"""
        select {columns} from (
            select *, row_number() over (partition by video_id, region, trending_date_parsed
                order by {first} views desc nulls last, likes desc nulls last, comment_count desc nulls last, {_TIES}) as rn
            from ({rows})
        ) where rn = 1
    """


_BACKFILL_ROWS = f"""
    select *, {RATES_SQL} from (
        select * exclude (day, views, dislikes), coalesce(views, 0) as views, 0 as dislikes, day as trending_date_parsed
        from ({_TYPED}) where trim(video_id) <> ''
    )
"""

# --- live rows as text, from events ----------------------------------------------------------------
_K = "cast(get_json_object(props, '$.k') as bigint)"
RAW_LIVE = rf"""
    select case when event_type = 'error' and {_K} < 10 then '\t ' else cast(user_id as string) end as video_id,
           concat('t', cast(event_id as string)) as title,
           cast(null as string) as channel_id,
           event_type as channel_title,
           case when event_type = 'view' then null else get_json_object(props, '$.k') end as category_id,
           cast(null as string) as publish_time,
           cast(null as string) as tags,
           case when value < 100 then 'x' when value < 200 then cast(value as string) when value < 250 then null
                when value < 300 then '1e3' else get_json_object(props, '$.k') end as views,
           get_json_object(props, '$.k') as likes,
           '0' as dislikes,
           cast(event_id as string) as comment_count,
           case when event_type = 'click' then null else 'true' end as comments_disabled,
           'false' as ratings_disabled,
           upper(event_type) as region,
           case when event_type = 'signup' and {_K} < 5 then 'never'
                else date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'") end as _ingested_at,
           'made' as _source
    from {{events}}
"""
_K_SQL = "cast(json_extract_string(props, '$.k') as bigint)"
LIVE_VIEWS_SQL = f"""case when value < 100 then 0 when value < 200 then cast(trunc(value) as bigint) when value < 250 then 0
     when value < 300 then 1000 else {_K_SQL} end"""
LIVE_ROWS_SQL = f"""
    select *, {RATES_SQL} from (
        select cast(user_id as varchar) as video_id,
               case when event_type = 'signup' and {_K_SQL} < 5 then null else strftime(ts, '%Y-%m-%d') end as trending_date,
               't' || event_id as title,
               event_type as channel_title,
               case when event_type = 'view' then 0 else {_K_SQL} end as category_id,
               cast(null as varchar) as publish_time,
               cast(null as varchar) as tags,
               {LIVE_VIEWS_SQL} as views,
               {_K_SQL} as likes,
               cast(0 as bigint) as dislikes,
               event_id as comment_count,
               event_type <> 'click' as comments_disabled,
               false as ratings_disabled,
               event_type as region,
               case when event_type = 'signup' and {_K_SQL} < 5 then null else cast(ts as date) end as trending_date_parsed,
               case when event_type = 'signup' and {_K_SQL} < 5 then null else ts end as source_time
        from events where not (event_type = 'error' and {_K_SQL} < 10)
    )
"""

# --- the same keys from both sides ------------------------------------------------------------------
_OLD = """
    select cast(user_id + event_id % 2 as string) as video_id, date_format(ts, 'yy.dd.MM') as trending_date, 'old' as title,
           event_type as channel_title, cast(null as string) as category_id, cast(null as string) as publish_time,
           cast(null as string) as tags, cast(event_id * 1000 as string) as views, '1' as likes, '2' as dislikes,
           '3' as comment_count, 'False' as comments_disabled, 'False' as ratings_disabled, event_type as region
    from {events}
"""
_UNION_SQL = f"""
    select * exclude (source_time), source_time from (
        select * from ({LIVE_ROWS_SQL})
        union all by name
        select *, {RATES_SQL}, cast(null as timestamp) as source_time from (
            select cast(user_id + event_id % 2 as varchar) as video_id, strftime(ts, '%y.%d.%m') as trending_date, 'old' as title,
                   event_type as channel_title, cast(null as bigint) as category_id,
                   cast(null as varchar) as publish_time, cast(null as varchar) as tags,
                   event_id * 1000 as views, cast(1 as bigint) as likes, cast(2 as bigint) as dislikes,
                   cast(3 as bigint) as comment_count, false as comments_disabled, false as ratings_disabled,
                   event_type as region, cast(ts as date) as trending_date_parsed
            from events
        )
    )
"""

RAW_REFERENCE = f"""
    select case when event_type = 'error' then 'x1' else get_json_object(props, '$.k') end as category_id,
           concat(event_type, cast(event_id as string)) as category_name,
           concat(' R', cast(user_id as string)) as region,
           date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'") as _ingested_at
    from {{events}}
"""

_BLANKS = r"""
    select event_id, case event_type when 'error' then '' when 'view' then ' \t\n' when 'click' then null
                                     when 'signup' then concat(' ', cast(user_id as string))
                                     else concat(char(160), case when value < 250 then '' else 'v' end) end as video_id
    from {events}
"""


def rows_out(df):
    return portable(df.select(*_OUT))


def _align(spark, sf_dir):
    schema = T.StructType([STATISTICS[c] for c in ("video_id", "title", "views", "trending_date_parsed", "region")])
    orders = over(spark, sf_dir, "select cast(o_orderkey as string) as video_id, o_custkey as views, "
                                 "cast(o_orderdate as date) as trending_date_parsed, 1 as extra from {orders}", "orders")
    events = over(spark, sf_dir, "select event_type as region, cast(event_id as string) as video_id, "
                                 "props as title from {events}", "events")
    return portable(cleanse.align_columns(orders, schema).unionByName(cleanse.align_columns(events, schema)))


def _customers(spark, sf_dir):
    return over(spark, sf_dir, "select c_custkey, concat('  ', upper(c_mktsegment), ' ') as region from {customer}", "customer")


def _gaps(spark, sf_dir):
    return over(spark, sf_dir, """
        select l_orderkey, l_linenumber, nullif(l_partkey, l_suppkey) as category_id,
               case when l_returnflag <> 'A' then cast(l_quantity as bigint) end as views,
               case when l_returnflag <> 'N' then l_suppkey end as likes,
               case when l_linestatus = 'O' then l_partkey end as dislikes,
               cast(null as bigint) as comment_count
        from {lineitem}""", "lineitem")


def _union(spark, sf_dir):
    old = cleanse.cleanse_backfill(over(spark, sf_dir, _OLD, "events"), "backfill")
    live = cleanse.cleanse_live(over(spark, sf_dir, RAW_LIVE, "events"), "live")
    return rows_out(dedup.latest_statistics(old.unionByName(live, allowMissingColumns=True)))


QUERIES = {
    "silver_schema_enforce": lambda s, d: cleanse.enforce_backfill_types(over(s, d, RAW_BACKFILL, "lineitem")),
    "trending_date_parse": lambda s, d: portable(
        cleanse.add_trending_date(over(s, d, RAW_BACKFILL, "lineitem").select("trending_date", "title"))
        .groupBy("trending_date", "title", "trending_date_parsed").agg(F.count("*").alias("n"))),
    "derived_rates": lambda s, d: cleanse.add_rates(facts(s, d)).select(
        "video_id", "views", "likes", "dislikes", "comment_count", "like_ratio", "engagement_rate"),
    "backfill_silver": lambda s, d: rows_out(dedup.latest_statistics(
        cleanse.cleanse_backfill(over(s, d, RAW_BACKFILL, "lineitem"), "backfill"))),
    "numeric_coerce_zero": lambda s, d: over(s, d, RAW_LIVE, "events").select(
        F.col("comment_count").cast("bigint").alias("event_id"), fn.to_long_or_zero(F.col("views")).alias("views"),
        fn.to_long_or_zero(F.col("category_id")).alias("category_id")),
    "column_align": _align,
    "region_normalize": lambda s, d: _customers(s, d).select(
        "c_custkey", fn.normalize_region(F.col("region")).alias("region")),
    "region_filter": lambda s, d: cleanse.filter_regions(_customers(s, d), [" Building", "MACHINERY "]).select(
        "c_custkey", fn.normalize_region(F.col("region")).alias("region")),
    "fill_numeric_nulls": lambda s, d: portable(cleanse.fill_metric_nulls(_gaps(s, d))),
    "drop_blank_ids": lambda s, d: cleanse.drop_blank_ids(over(s, d, _BLANKS, "events")),
    "dedup_latest": lambda s, d: portable(dedup.latest_per_key(
        over(s, d, "select event_id, user_id, event_type, cast(ts as date) as day, ts, value from {events}", "events"),
        ["user_id", "event_type", "day"], ["ts", "event_id"],
    ).drop("ts")),
    "dedup_live": lambda s, d: rows_out(dedup.latest_statistics(
        cleanse.cleanse_live(over(s, d, RAW_LIVE, "events"), "live"))),
    "union_silver": _union,
    "silver_reference_clean": lambda s, d: clean_reference(over(s, d, RAW_REFERENCE, "events")).drop("_processed_at"),
}

SQL = {
    "silver_schema_enforce": f"select * exclude (day) from ({_TYPED})",
    "trending_date_parse": f"""
        select trending_date, title, cast(day as varchar) as trending_date_parsed, count(*) as n
        from ({_TYPED}) group by all
    """,
    "derived_rates": f"""
        select video_id, views, likes, dislikes, comment_count, like_ratio, engagement_rate from ({STATS_SQL})
    """,
    "backfill_silver": _latest_sql(_BACKFILL_ROWS),
    "numeric_coerce_zero": f"""
        select event_id, {LIVE_VIEWS_SQL} as views,
               case when event_type = 'view' then 0 else {_K_SQL} end as category_id
        from events
    """,
    "column_align": """
        select cast(o_orderkey as varchar) as video_id, cast(null as varchar) as title, o_custkey as views,
               cast(cast(o_orderdate as date) as varchar) as trending_date_parsed, cast(null as varchar) as region
        from orders
        union all
        select cast(event_id as varchar), props, null, null, event_type from events
    """,
    "region_normalize": "select c_custkey, lower(c_mktsegment) as region from customer",
    "region_filter": """
        select c_custkey, lower(c_mktsegment) as region from customer
        where lower(c_mktsegment) in ('building', 'machinery')
    """,
    "fill_numeric_nulls": """
        select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, nullif(l_partkey, l_suppkey) as category_id,
               case when l_returnflag <> 'A' then cast(l_quantity as bigint) else 0 end as views,
               case when l_returnflag <> 'N' then l_suppkey else 0 end as likes,
               case when l_linestatus = 'O' then l_partkey else 0 end as dislikes,
               cast(0 as bigint) as comment_count
        from lineitem
    """,
    "drop_blank_ids": """
        select event_id, case when event_type = 'signup' then ' ' || user_id else chr(160) || 'v' end as video_id
        from events where event_type = 'signup' or (event_type = 'purchase' and value >= 250)
    """,
    "dedup_latest": """
        select event_id, user_id, event_type, cast(day as varchar) as day, value from (
            select *, cast(ts as date) as day,
                   row_number() over (partition by user_id, event_type, cast(ts as date) order by ts desc, event_id desc) as rn
            from events) where rn = 1
    """,
    "dedup_live": _latest_sql(LIVE_ROWS_SQL, "source_time desc nulls last,"),
    "union_silver": _latest_sql(_UNION_SQL, "source_time desc nulls last,"),
    "silver_reference_clean": f"""
        select category_id, category_name, region from (
            select {_K_SQL} as category_id, event_type || event_id as category_name, 'r' || user_id as region,
                   row_number() over (partition by user_id, {_K_SQL} order by ts desc, event_type || event_id desc) as rn
            from events where event_type <> 'error'
        ) where rn = 1
    """,
}
