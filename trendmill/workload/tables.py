"""The given tables seen as trending statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmill.operators.broadcasting import broadcast_if_small
from trendmill.operators.cleanse import add_rates
from trendmill.operators.reference import measured_lookup
from trendmill.plans.pipeline import build_gold
from trendmill.session import fresh_path, use_job_settings
from trendmill.sources.tables import Layout, ensure_table, overwrite_partitions


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_job_settings(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# One row per order line: part = video, customer's region = region, order day = trending day,
# supplier = channel, supplier's nation = category. Line 7 gets zero views.
_FACT = """
    select cast(l_partkey as {text}) as video_id,
           lower(trim(r_name)) as region,
           cast(o_orderdate as date) as trending_date_parsed,
           s_name as channel_title,
           cast(s_nationkey as bigint) as category_id,
           case when l_linenumber = 7 then cast(0 as bigint)
                else cast(round(l_extendedprice) as bigint) end as views,
           cast(l_quantity as bigint) as likes,
           cast(round(l_tax * 100) as bigint) as dislikes,
           cast(l_linenumber as bigint) as comment_count
    from {lineitem} join {orders} on l_orderkey = o_orderkey
                    join {customer} on o_custkey = c_custkey
                    join {nation} on c_nationkey = n_nationkey
                    join {region} on n_regionkey = r_regionkey
                    join {supplier} on l_suppkey = s_suppkey
"""
_FACT_TABLES = ("lineitem", "orders", "customer", "nation", "region", "supplier")

FACT_SQL = _FACT.format(text="varchar", **{name: name for name in _FACT_TABLES})

# The same rows for Spark, in an order of joins that moves order lines once.
_PLACES = """
    select c_custkey, lower(trim(r_name)) as region
    from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
"""
_PLACED_FACT = _FACT.split(" from ")[0].replace("lower(trim(r_name))", "region").format(text="string") + """
    from {lineitem} join {orders} on l_orderkey = o_orderkey join {supplier} on l_suppkey = s_suppkey
"""


def half_up(expression: str, places: int) -> str:
    """SQL that rounds the shortest decimal form of a double half up, not its binary value."""
    return f"cast(round(cast(cast({expression} as varchar) as decimal(38,18)), {places}) as double)"


RATES_SQL = f"""
    case when views > 0 then {half_up('likes::double / views * 100', 4)} else 0.0 end as like_ratio,
    case when views > 0 then {half_up('(likes + dislikes + comment_count)::double / views * 100', 4)} else 0.0 end
        as engagement_rate
"""
STATS_SQL = f"select *, {RATES_SQL} from ({FACT_SQL})"

# The last nations have no category name, so their rows are 'Unknown'.
_CATEGORY_NAME = "case when n_nationkey < 20 then n_name end"
LOOKUP_SQL = f"select cast(n_nationkey as bigint) as category_id, {_CATEGORY_NAME} as category_name from nation"


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of FACT_SQL.

    Customers are joined to the orders, not to the order lines. The merge join is asked for at every size: whether the
    orders are small enough to broadcast would decide if order lines are shuffled.
    """
    places = over(spark, sf_dir, _PLACES, "customer", "nation", "region")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    placed = orders.join(broadcast_if_small(places), F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return spark.sql(_PLACED_FACT, lineitem=table(spark, sf_dir, "lineitem"), orders=placed.hint("merge"),
                     supplier=broadcast_if_small(suppliers))


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_rates(facts(spark, sf_dir))


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over(spark, sf_dir, f"""
        select cast(n_nationkey as bigint) as category_id, {_CATEGORY_NAME} as category_name, lower(r_name) as region
        from {{nation}} join {{region}} on n_regionkey = r_regionkey""", "nation", "region")


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured_lookup(reference(spark, sf_dir))


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text, small integers as bigint and arrays joined, so any SQL engine compares them."""
    def plain(name: str, kind: str):
        if kind in ("date", "timestamp", "timestamp_ntz"):
            return F.col(name).cast("string").alias(name)
        if kind in ("int", "smallint", "tinyint"):
            return F.col(name).cast("bigint").alias(name)
        if kind == "array<string>":
            return F.array_join(name, "|").alias(name)
        return F.col(name)

    return df.select([plain(name, kind) for name, kind in df.dtypes])


def over(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    """Run SQL text in which the named tables are the given ones."""
    return spark.sql(text, **{name: table(spark, sf_dir, name) for name in names})


def fresh_layout(spark: SparkSession) -> Layout:
    """A database and folder of its own, so that a query never meets another one's tables."""
    use_job_settings(spark)
    root = fresh_path(spark, "tables")
    database = "trendmill_" + root.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    return Layout(root, database)


_silver_paths: dict[tuple[str, str], str] = {}
_published: dict[tuple[str, str], Layout] = {}


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics as a Silver table in the shared folder, written once per session and scale."""
    key = (spark.sparkContext.applicationId, sf_dir)
    rows = stats(spark, sf_dir)
    if key not in _silver_paths:
        path = fresh_path(spark, "silver")
        rows.write.partitionBy("region").parquet(path)
        _silver_paths[key] = path
    return spark.read.schema(rows.schema).parquet(_silver_paths[key])


def published(spark: SparkSession, sf_dir: str) -> Layout:
    """The Gold tables as the build job publishes them over ``silver``, once per session and scale."""
    key = (spark.sparkContext.applicationId, sf_dir)
    rows = silver(spark, sf_dir)
    if key not in _published:
        layout = fresh_layout(spark)
        ensure_table(spark, layout.statistics, _silver_paths[key], rows.schema, ("region",))
        overwrite_partitions(reference(spark, sf_dir), layout.reference, layout.path("clean_reference_data"))
        build_gold(spark, layout)
        _published[key] = layout
    return _published[key]
