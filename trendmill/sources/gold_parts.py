"""The tables of Gold parts, and which Silver files each part was made from.

A part belongs to a (region, month) partition of Silver. Beside the parts lies a record of the files they were made from,
as one number per partition; a partition whose files are others now is stale. The record is written after the parts, so
a run that dies leaves them stale, and it does not matter who changed Silver or how often. Files are known from their
listing alone. The folder can be removed as a whole; the next run makes it again.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmill.operators.gold_partial import parts_of
from trendmill.schemas import SILVER_PARTITIONS
from trendmill.session import planned_bytes, sized_shuffles
from trendmill.sources import ledger
from trendmill.sources.bronze_csv import NOTHING_THERE
from trendmill.sources.landing import in_partitions
from trendmill.sources.tables import (
    Layout, drop_partitions, ensure_table, insert_partitions, overwrite_mode, partition_names,
)

FOLDER = "gold_parts"
# Raise this number with any change of what parts hold: all of them are then stale.
_FORM = 1
_RECORD = "region string, trending_month string, files string"


def _table(layout: Layout, name: str) -> str:
    return layout.table(f"gold_part_{name}")


def _record_path(layout: Layout) -> str:
    return layout.path(f"{FOLDER}/made_from")


def silver_files(spark: SparkSession, layout: Layout) -> dict[tuple, str | None]:
    """{(region, month): what its files are now} of all Silver partitions; None if they could not be told."""
    spark.catalog.refreshTable(layout.statistics)
    names = partition_names(spark, layout.statistics)
    folder = r"/(%s)/[^/]*$" % "/".join(f"{key}=[^/]*" for key in SILVER_PARTITIONS)
    one = F.xxhash64("file", "size", "modified")
    found = ledger.find_files(spark, layout.path("clean_statistics")) \
        .groupBy(F.regexp_extract("file", folder, 1).alias("folder")) \
        .agg(F.concat_ws(" ", F.lit(_FORM), F.count(one), F.hex(F.bit_xor(one))).alias("files")).collect()
    files = {unquote(r["folder"]): r["files"] for r in found}
    return {values: files.get(name) for values, name in names.items()}


def _recorded(spark: SparkSession, layout: Layout) -> dict[tuple, str]:
    try:
        rows = spark.read.schema(_RECORD).parquet(_record_path(layout)).collect()
    except AnalysisException as error:
        if error.getCondition() not in NOTHING_THERE:
            raise
        return {}
    return {(r["region"], r["trending_month"]): r["files"] for r in rows}


def read(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {name: spark.table(_table(layout, name)) for name in parts_of(spark.table(layout.statistics))}


def refresh(spark: SparkSession, layout: Layout) -> list[tuple]:
    """Make stale parts anew and remove those without a Silver partition; returns these (region, month) partitions.

    No file of any other Silver partition is opened. Only names of partitions and a number for each come to the driver.
    """
    silver = spark.table(layout.statistics)
    if tuple(silver.columns[-len(SILVER_PARTITIONS):]) != SILVER_PARTITIONS:
        raise ValueError(f"{layout.statistics} is not partitioned by {', '.join(SILVER_PARTITIONS)}")
    kept: set[tuple] | None = None
    for name, part in parts_of(silver).items():
        ensure_table(spark, _table(layout, name), layout.path(f"{FOLDER}/{name}"), part.schema, SILVER_PARTITIONS)
        there = partition_names(spark, _table(layout, name)).keys()
        kept = set(there) if kept is None else kept & there
    now, before = silver_files(spark, layout), _recorded(spark, layout)
    stale = {p for p, files in now.items() if p not in kept or files is None or files != before.get(p)}
    gone = (before.keys() | kept) - now.keys()
    if not stale and not gone:
        return []
    rows = silver.filter(in_partitions(stale))

    def write(name: str, part: DataFrame) -> None:
        table = _table(layout, name)
        done = insert_partitions(part, table, SILVER_PARTITIONS)[0] if stale else set()
        old = {p: place for p, place in partition_names(spark, table).items() if p in (stale | gone) - done}
        drop_partitions(spark, table, SILVER_PARTITIONS, old)

    parts = parts_of(rows)
    # The mode is the session's, so it is set once around all of them.
    with sized_shuffles(spark, planned_bytes(rows)), overwrite_mode(spark, "dynamic"), \
            ThreadPoolExecutor(len(parts)) as pool:
        list(pool.map(write, parts, parts.values()))
    made = [(*p, files) for p, files in now.items() if files is not None]
    spark.createDataFrame(made, _RECORD).coalesce(1).write.mode("overwrite").parquet(_record_path(layout))
    return sorted(stale | gone, key=str)
