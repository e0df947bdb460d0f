"""Landing and the rebuild of Silver from it.

Silver is never rewritten from itself: an overwrite that dies half way would lose rows for good. Every cleaned batch is
first kept under its feed and batch id, then the touched Silver partitions are rebuilt from what is kept for them.
Repeating either step gives the same rows again. Landing is partitioned by region and month first, so a rebuild opens
only the months it is for; batches of a month that no one can repeat any more are folded into one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmill import functions as fn
from trendmill.operators.broadcasting import broadcast_if_small
from trendmill.operators.dedup import latest_per_file, latest_statistics
from trendmill.schemas import LANDING, LANDING_PARTITIONS, SILVER_PARTITIONS, STATISTICS
from trendmill.session import folder_bytes, folder_names, planned_bytes, remove_folder, sized_shuffles, small_scans
from trendmill.sources import ledger
from trendmill.sources.tables import (
    Layout, drop_partitions, ensure_table, insert_partitions, partition_names, read_or_none, write_full,
)

BACKFILL = "backfill"
# The feed name of folded batches.
FOLDED = "folded"
# Batches a (region, month) may have before they are folded.
MAX_BATCHES = 12
_BEHIND = "region string, trending_month string"


def landing(spark: SparkSession, layout: Layout) -> DataFrame:
    ensure_table(spark, layout.landing, layout.path("landing/statistics"), LANDING, LANDING_PARTITIONS)
    return spark.table(layout.landing)


def batch_rows(spark: SparkSession, layout: Layout, feed: str, batch_id: int) -> DataFrame:
    return landing(spark, layout).filter((F.col("feed") == feed) & (F.col("batch_id") == batch_id))


def batch_partitions(spark: SparkSession, layout: Layout, feed: str, batch_id: int) -> dict[tuple, str]:
    landing(spark, layout)
    return partition_names(spark, layout.landing, feed=feed, batch_id=batch_id)


def land(rows: DataFrame, layout: Layout, feed: str, batch_id: int) -> tuple[int, list[tuple]]:
    """Keep a cleaned batch of a feed; returns its number of rows and the (region, month) partitions it changes.

    A batch that is repeated replaces itself: partitions it no longer has rows for go away, and count as changed. Rows of
    a partition are brought together first, so the number of files does not grow with the number of tasks.
    """
    spark = rows.sparkSession
    before = batch_partitions(spark, layout, feed, batch_id)
    batch = F.lit(batch_id).cast("bigint")
    landed = rows.withColumns({
        "trending_month": fn.month_of(F.col("trending_date_parsed")), "feed": F.lit(feed), "batch_id": batch,
        "origin_batch": batch})
    after, count = insert_partitions(landed, layout.landing, LANDING_PARTITIONS)
    drop_partitions(spark, layout.landing, LANDING_PARTITIONS, {p: name for p, name in before.items() if p not in after})
    return count, sorted({p[2:] for p in before.keys() | after}, key=str)


def in_partitions(partitions: Iterable[tuple]) -> Column:
    """Rows of these (region, month) partitions. It asks for partition columns alone, so no other folder is opened."""
    name = F.concat_ws("\0", *[F.coalesce(F.col(k), F.lit("\1")) for k in SILVER_PARTITIONS])
    return name.isin(["\0".join("\1" if v is None else v for v in p) for p in partitions])


def valid_rows(rows: DataFrame, files: DataFrame | None) -> DataFrame:
    """Landed rows that count: without those of files of which a later version has landed."""
    if files is None:
        return rows
    return rows.join(broadcast_if_small(ledger.superseded(files)), ["source_file", "origin_batch"], "left_anti")


def _silver(landed: DataFrame) -> DataFrame:
    return latest_statistics(landed).select(*[c for c in STATISTICS.fieldNames() if c != "region"], *SILVER_PARTITIONS)


def rebuild_all(spark: SparkSession, layout: Layout, files: DataFrame | None = None) -> None:
    """Silver statistics from everything that ever landed; ``files`` is the ledger to go by, if not the recorded one."""
    rows = valid_rows(landing(spark, layout), read_or_none(spark, layout.files) if files is None else files)
    with sized_shuffles(spark, folder_bytes(spark, layout.path("landing/statistics"))), small_scans(spark):
        write_full(_silver(rows), layout.statistics, layout.path("clean_statistics"), SILVER_PARTITIONS)


def rebuild(spark: SparkSession, layout: Layout, partitions: Iterable[tuple], files: DataFrame | None = None) -> None:
    """Silver statistics of some (region, month) partitions from all that landed for them.

    If there is no Silver table, all of it is built. ``files`` is the ledger to go by, if not the recorded one.
    """
    landed, wanted = landing(spark, layout), set(partitions)
    if not spark.catalog.tableExists(layout.statistics):
        rebuild_all(spark, layout, files)
        return
    landed = landed.filter(in_partitions(wanted))
    rows = valid_rows(landed, read_or_none(spark, layout.files) if files is None else files)
    with sized_shuffles(spark, planned_bytes(landed)), small_scans(spark):
        done, _ = insert_partitions(_silver(rows), layout.statistics, SILVER_PARTITIONS)
    gone = wanted - done
    if gone:
        names = partition_names(spark, layout.statistics)
        drop_partitions(spark, layout.statistics, SILVER_PARTITIONS, {p: n for p, n in names.items() if p in gone})


def postpone(spark: SparkSession, layout: Layout, partitions: Iterable[tuple]) -> None:
    """Note that Silver of these (region, month) partitions is behind landing, until ``catch_up`` has rebuilt them.

    The note is a folder of its own, so that no other run takes a note away that it has not read.
    """
    rows = spark.createDataFrame([tuple(p) for p in partitions], _BEHIND).coalesce(1)
    rows.write.option("ignoreNullFields", "false").json(layout.path(f"landing/behind/{uuid.uuid4().hex}"))


def catch_up(spark: SparkSession, layout: Layout) -> None:
    """Rebuild, once, all partitions that were postponed, by this run or by one that died before it came to it."""
    notes = folder_names(spark, layout.path("landing/behind/*"))
    if not notes:
        return
    landing(spark, layout)
    spark.catalog.refreshTable(layout.landing)  # batches are landed in a session of their own
    wanted = {tuple(r) for r in spark.read.schema(_BEHIND).json(notes).distinct().collect()}
    if wanted:
        rebuild(spark, layout, wanted)
    for note in notes:
        remove_folder(spark, note)


def fold(spark: SparkSession, layout: Layout, max_batches: int = MAX_BATCHES) -> list[tuple]:
    """Fold the batches of every (region, month) that has more than ``max_batches`` of them; returns these partitions.

    Of all its batches but the open ones, a partition keeps one: per key and source file the row that would win, and
    nothing of superseded file versions. A batch is open if it may still be repeated: the last one of a feed, and a
    backfill that the ledger does not have. What a folded batch held is marked by ``origin_batch`` and ``source_file``
    of its rows. The folded rows are written before the batches go away, and a row that is there twice decides nothing,
    so a run that dies in between, or a batch that comes again after all, changes no result.
    """
    landing(spark, layout)
    names = partition_names(spark, layout.landing)
    files = read_or_none(spark, layout.files)
    closed = {BACKFILL: 0 if files is None else ledger.next_batch(files, BACKFILL) - 1}
    for feed, batch, *_ in names:
        if feed not in (BACKFILL, FOLDED):
            closed[feed] = max(closed.get(feed, -1), int(batch) - 1)
    groups: dict[tuple, dict[tuple, str]] = {}
    for key, name in names.items():
        feed, batch, *place = key
        if feed == FOLDED or int(batch) <= closed[feed]:
            groups.setdefault(tuple(place), {})[key] = name
    groups = {place: batches for place, batches in groups.items() if len(batches) > max_batches}
    if not groups:
        return []
    number = 1 + max((int(key[1]) for key in names if key[0] == FOLDED), default=0)
    open_now = F.lit(False)
    for feed, last in closed.items():
        open_now = open_now | ((F.col("feed") == feed) & (F.col("batch_id") > last))
    rows = spark.table(layout.landing).filter(in_partitions(groups) & ~open_now)
    with sized_shuffles(spark, planned_bytes(rows)), small_scans(spark):
        insert_partitions(
            latest_per_file(valid_rows(rows, files)).withColumns({"feed": F.lit(FOLDED), "batch_id": F.lit(number).cast("bigint")}),
            layout.landing, LANDING_PARTITIONS)
    old = {key: name for batches in groups.values() for key, name in batches.items()}
    drop_partitions(spark, layout.landing, LANDING_PARTITIONS, old)
    return sorted(groups, key=str)
