"""Data-quality checks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendmill.operators.quality import Rules, check_table, verdict
from trendmill.workload.tables import over, portable

# Events as a statistics table: some titles are null, channel_title does not exist, views leave their range.
_EVENTS = """
    select cast(user_id as string) as video_id, case when value < 30 then null else event_type end as title,
           cast(trunc_value as bigint) - 5 as views, event_type as region, cast(ts as timestamp) as _processed_at
    from (select *, cast(value as bigint) as trunc_value from {events})
"""
# Orders as a statistics table: complete, but old.
_ORDERS = """
    select cast(o_orderkey as string) as video_id, o_orderstatus as title, o_orderpriority as channel_title,
           cast(o_custkey as bigint) as views, lower(o_orderstatus) as region,
           date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'+00:00'") as _ingested_at
    from {orders}
"""
_RULES = Rules(max_value=400)
_AS_OF = "2024-02-01 12:00:00"


def _events(spark, sf_dir):
    return check_table(over(spark, sf_dir, _EVENTS, "events"), "clean_statistics", _RULES,
                       F.lit(_AS_OF).cast("timestamp"))


def _orders(spark, sf_dir):
    return check_table(over(spark, sf_dir, _ORDERS, "orders"), "clean_statistics", Rules(),
                       F.lit(_AS_OF).cast("timestamp"))


def _only(check, *columns):
    def query(spark, sf_dir):
        both = _events(spark, sf_dir).withColumn("source", F.lit("events")).unionByName(
            _orders(spark, sf_dir).withColumn("source", F.lit("orders")))
        return portable(both.filter(F.col("check") == check).select("source", "check", *columns, "passed", "message"))
    return query


def _verdict(spark, sf_dir):
    return verdict(_events(spark, sf_dir)).withColumn("source", F.lit("events")).unionByName(
        verdict(_orders(spark, sf_dir)).withColumn("source", F.lit("orders")))


QUERIES = {
    "dq_row_count": _only("row_count", "value", "threshold"),
    "dq_nulls": _only("null_pct", "column", "value", "threshold"),
    "dq_schema": _only("schema", "missing"),
    "dq_value_range": _only("value_range", "column", "negative", "extreme"),
    "dq_freshness": _only("freshness", "latest"),
    "dq_verdict": _verdict,
}

_E = "(select * exclude (value), cast(trunc(value) as bigint) - 5 as views, value from events)"
_RANGE = f"""
    select 'events' as source, 'value_range' as "check", 'views' as "column",
           count(*) filter (where views < 0) as negative, count(*) filter (where views > 400) as extreme from {_E}
    union all
    select 'orders', 'value_range', 'views', count(*) filter (where o_custkey < 0),
           count(*) filter (where o_custkey > 50000000000) from orders
"""


def _null_row(source: str, column: str, condition: str) -> str:
    percent = f"count(*) filter (where {condition}) * 1.0 / count(*) * 100"
    return f"""
        select '{source}' as source, 'null_pct' as "check", '{column}' as "column", round({percent}, 2) as value,
               5.0::double as threshold, {percent} <= 5.0 as passed,
               printf('%.2f %% of {column} are empty, 5.0 %% allowed', {percent}) as message
        from {source}
    """


_NULLS = " union all ".join([
    _null_row("events", "video_id", "user_id is null"),
    _null_row("events", "title", "value < 30"),
    """select 'events', 'null_pct', 'channel_title', null, null, false, 'there is no channel_title'""",
    _null_row("events", "views", "value is null"),
    _null_row("events", "region", "event_type is null"),
    _null_row("orders", "video_id", "o_orderkey is null"),
    _null_row("orders", "title", "o_orderstatus is null"),
    _null_row("orders", "channel_title", "o_orderpriority is null"),
    _null_row("orders", "views", "o_custkey is null"),
    _null_row("orders", "region", "o_orderstatus is null"),
])
_CUTOFF = "timestamp '2024-01-30 12:00:00'"
_PASSES = f"""
    select source, count(*) filter (where passed) as n, count(*) as total from (
        select 'events' as source, count(*) >= 10 as passed from events
        union all select 'orders', count(*) >= 10 from orders
        union all select source, passed from ({_NULLS})
        union all select 'events', false union all select 'orders', true
        union all select source, negative = 0 and extreme = 0 from ({_RANGE})
        union all select 'events', max(ts) >= {_CUTOFF} from events
        union all select 'orders', max(o_orderdate) >= {_CUTOFF} from orders
    ) group by source
"""

SQL = {
    "dq_row_count": """
        select 'events' as source, 'row_count' as "check", count(*)::double as value, 10.0::double as threshold,
               count(*) >= 10 as passed, 'counted ' || count(*) || ', at least 10 wanted' as message from events
        union all
        select 'orders', 'row_count', count(*)::double, 10.0::double, count(*) >= 10, 'counted ' || count(*) || ', at least 10 wanted'
        from orders
    """,
    "dq_nulls": _NULLS,
    "dq_schema": """
        select 'events' as source, 'schema' as "check", 'channel_title' as missing, false as passed,
               'without channel_title' as message
        union all select 'orders', 'schema', '', true, 'complete'
    """,
    "dq_value_range": f"""
        select *, negative = 0 and extreme = 0 as passed,
               'views below zero: ' || negative || ', above ' || case source when 'events' then '400' else '50000000000' end
               || ': ' || extreme as message
        from ({_RANGE})
    """,
    "dq_freshness": f"""
        select *, 'newest row from ' || latest || ', wanted since 2024-01-30 12:00:00' as message from (
            select 'events' as source, 'freshness' as "check", cast(max(ts) as varchar) as latest,
                   max(ts) >= {_CUTOFF} as passed from events
            union all
            select 'orders', 'freshness', strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S'), max(o_orderdate) >= {_CUTOFF}
            from orders)
    """,
    "dq_verdict": f"""
        select source, n = total as quality_passed, n as checks_passed, total as checks_total from ({_PASSES})
    """,
}
