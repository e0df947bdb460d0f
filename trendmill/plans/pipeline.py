"""The jobs a user runs: ingest, backfill, live run, reference load, quality gate, Gold build."""

from __future__ import annotations

from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trendmill.operators import gold
from trendmill.operators import gold_partial as partial
from trendmill.operators.audit import counted
from trendmill.operators.cleanse import cleanse_backfill
from trendmill.operators.flatten import DEFAULT_SOURCE, flatten_categories, flatten_videos, payload_summary
from trendmill.operators.quality import Rules, check_tables, verdict
from trendmill.operators.reference import clean_reference, measured_lookup
from trendmill.session import enable_checkpoints, folder_bytes, sized_shuffles, stored_bytes, use_job_settings
from trendmill.sources import gold_parts, ledger
from trendmill.sources.bronze_csv import read_backfill
from trendmill.sources.bronze_json import read_reference, write_bronze
from trendmill.sources.landing import BACKFILL, batch_partitions, batch_rows, fold, land, rebuild
from trendmill.sources.published import merge, point_to, remove_old_versions, write_version
from trendmill.sources.tables import Layout, read_or_none
from trendmill.streaming.live import run_live


def run_ingest(
    videos: DataFrame, categories: DataFrame, live_path: str, reference_path: str, ingested_at: str,
    source: str = DEFAULT_SOURCE,
) -> DataFrame:
    """Nested payloads (region, payload) to Bronze files; returns what could be read per region and kind.

    A payload that is no JSON gives no rows and is counted as failed; the other regions are not affected. A run that is
    repeated for the same time replaces its files.
    """
    use_job_settings(videos.sparkSession)
    at = F.lit(ingested_at)
    write_bronze(flatten_videos(videos.withColumn("_ingested_at", at), source), live_path, ingested_at)
    write_bronze(flatten_categories(categories.withColumn("_ingested_at", at), source), reference_path, ingested_at,
                 hourly=False)
    kinds = (("trending", videos), ("categories", categories))
    summaries = [payload_summary(rows).withColumn("kind", F.lit(kind)) for kind, rows in kinds]
    return summaries[0].unionByName(summaries[1])


def run_backfill(
    spark: SparkSession, csv_path: str, layout: Layout, regions: Collection[str] | None = None,
    job_name: str = BACKFILL, multi_line: bool = True,
) -> dict:
    """CSV history to Silver: files that are new or changed land as one batch, then what they touch is rebuilt.

    History accumulates: folders can be loaded one after the other, in any order and any number of times. A file that
    has changed replaces the rows of its earlier version, so what was corrected downward or taken out leaves Silver; all
    other files keep theirs, also files that are gone from the folder. ``regions`` limits a run to files below these
    ``region=`` folders. Files are taken by path, size and time; nothing is read of those known already.

    Returns the counts of this run: ``files_read``, ``rows_read`` and ``rows_landed``.
    """
    use_job_settings(spark)
    enable_checkpoints(spark)
    found = ledger.find_files(spark, csv_path, regions)
    known = ledger.entries(spark, layout)
    changed = ledger.changed_files(found, known).checkpoint()
    size, n_files = changed.agg(F.sum("size"), F.count("*")).first()
    batch = ledger.next_batch(known, BACKFILL)
    # A run that died before it was recorded may have left rows under this number.
    if n_files == 0 and not (spark.catalog.tableExists(layout.landing) and batch_partitions(spark, layout, BACKFILL, batch)):
        return {"files_read": 0, "rows_read": 0, "rows_landed": 0}
    only = changed
    if n_files <= ledger.MAX_NAMED_FILES:
        only = [r["file"] for r in changed.select("file").collect()]
    read = Observation()
    raw = read_backfill(spark, csv_path, multi_line, file_column="source_file", only=only)
    rows = cleanse_backfill(counted(raw, read), job_name, regions, keep=("source_file",))
    with sized_shuffles(spark, size or 0):
        landed, touched = land(rows, layout, BACKFILL, batch)
    entries = ledger.entries_of_batch(changed, batch_rows(spark, layout, BACKFILL, batch), BACKFILL, batch).checkpoint()
    touched = {*touched, *ledger.old_partitions(changed, known)}
    if touched:
        rebuild(spark, layout, touched, known.unionByName(entries))
    ledger.record(entries, layout)
    fold(spark, layout)
    return {"files_read": n_files, "rows_read": read.get["rows"], "rows_landed": landed}


def run_reference(spark: SparkSession, json_path: str, layout: Layout, on_bad_record: str = "drop_line") -> bool:
    """Category names to Silver, replacing the regions that occur; False if there was nothing to load.

    Readers see the old names until all new ones are there.
    """
    use_job_settings(spark)
    rows = clean_reference(read_reference(spark, json_path, on_bad_record))
    return merge(rows, layout.reference, layout.path("clean_reference_data")) is not None


def build_gold(spark: SparkSession, layout: Layout) -> dict[str, str]:
    """Rebuild the three Gold tables from all of Silver and let readers see them; returns the version of each.

    Without a usable reference table all categories are 'Unknown'.
    """
    use_job_settings(spark)
    stats, lookup = spark.table(layout.statistics), _lookup(spark, layout)
    return _publish_gold(layout, {
        "channel_analytics": lambda: gold.channel_analytics(stats, lookup),
        "category_analytics": lambda: gold.category_analytics(stats, lookup),
        "trending_analytics": lambda: gold.trending_analytics(stats),
    }, spark, folder_bytes(spark, layout.path("clean_statistics")))


def refresh_gold(spark: SparkSession, layout: Layout) -> list[tuple]:
    """The three Gold tables as ``build_gold`` makes them, but only months of Silver that have changed are read.

    Aggregates of each (region, month) are kept as parts. Parts whose Silver files are not those they were made from are
    made anew, whoever changed them and however many runs ago; Gold is then folded from the parts, which are small, with
    the category names of today. Returns the (region, month) partitions that were read or have gone.
    """
    use_job_settings(spark)
    changed = gold_parts.refresh(spark, layout)
    parts, lookup = gold_parts.read(spark, layout), _lookup(spark, layout)
    _publish_gold(layout, {
        "channel_analytics": lambda: partial.channels_from_parts(parts, lookup),
        "category_analytics": lambda: partial.categories_from_parts(parts, lookup),
        "trending_analytics": lambda: partial.days_from_parts(parts),
    }, spark, stored_bytes(spark, layout.path(gold_parts.FOLDER)))
    return changed


def _lookup(spark: SparkSession, layout: Layout) -> DataFrame | None:
    reference = read_or_none(spark, layout.reference)
    return None if reference is None else measured_lookup(reference)


def _publish_gold(
    layout: Layout, builds: dict[str, Callable[[], DataFrame]], spark: SparkSession, input_bytes: int
) -> dict[str, str]:
    """Write the tables and let readers see them; returns the version of each.

    The builds do not depend on each other and run side by side, so that one fills the executors the last tasks of
    another leave idle. Readers see the old tables until all are complete, and then the new ones: if one build fails,
    none of them changes.
    """
    def build(name: str) -> str:
        return write_version(gold.stamp_aggregated(builds[name]()), layout.table(name), layout.path(name))

    with sized_shuffles(spark, input_bytes), ThreadPoolExecutor(len(builds)) as pool:
        built = dict(zip(builds, pool.map(build, builds)))
    for name, version in built.items():
        point_to(spark, layout.table(name), version)
    for name in built:
        remove_old_versions(spark, layout.table(name), layout.path(name))
    return built


@dataclass(frozen=True)
class GateResult:
    quality_passed: bool
    checks_passed: int
    checks_total: int
    failed: DataFrame


def check_silver(
    spark: SparkSession, layout: Layout, rules: Rules = Rules(), as_of: Column | None = None,
    tables: tuple[str, ...] = ("clean_statistics", "clean_reference_data"),
) -> tuple[GateResult, DataFrame]:
    """The verdict on Silver and all check rows. One pass per table; only the check rows are kept."""
    checks = check_tables(spark, {name: layout.table(name) for name in tables}, rules, as_of)
    answer = verdict(checks).first()
    return GateResult(**answer.asDict(), failed=checks.filter(~F.col("passed"))), checks


def build_gold_if_clean(
    spark: SparkSession, layout: Layout, rules: Rules = Rules(), as_of: Column | None = None,
    build: Callable[[SparkSession, Layout], object] = build_gold,
) -> GateResult:
    """Build Gold only if every check passes; otherwise the old Gold stays and the failed checks come back.

    ``build`` may be ``refresh_gold``; what changes while the gate refuses is made up for by the next build.
    """
    result, _ = check_silver(spark, layout, rules, as_of)
    if result.quality_passed:
        build(spark, layout)
    return result


def run_live_cycle(
    spark: SparkSession, live_path: str, reference_path: str, layout: Layout, checkpoint: str,
    rules: Rules = Rules(), on_bad_record: str = "drop_line",
) -> GateResult:
    """One scheduled run: new live files and category names to Silver, then the gate, then Gold from what has changed."""
    run_live(spark, live_path, layout, checkpoint, on_bad_record)
    run_reference(spark, reference_path, layout, on_bad_record)
    return build_gold_if_clean(spark, layout, rules, build=refresh_gold)
