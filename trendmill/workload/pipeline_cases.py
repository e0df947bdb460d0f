"""Whole jobs: raw files in, tables out."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendmill import functions as fn
from trendmill.operators.cleanse import cleanse_backfill, cleanse_live
from trendmill.operators.dedup import latest_statistics
from trendmill.operators.quality import Rules
from trendmill.plans.pipeline import (
    build_gold_if_clean, check_silver, refresh_gold, run_backfill, run_ingest, run_live_cycle, run_reference,
)
from trendmill.schemas import SILVER_PARTITIONS
from trendmill.session import file_system, folder_names, fresh_path, small_scans, stored_bytes
from trendmill.sources.bronze_json import read_live
from trendmill.sources.landing import fold, rebuild_all
from trendmill.sources.tables import Layout, drop_partitions, overwrite_partitions, partition_names, write_full
from trendmill.streaming.live import run_live
from trendmill.workload import silver_cases
from trendmill.workload.bronze_cases import INGESTED_AT, write_csv
from trendmill.workload.gold_cases import SQL as GOLD_SQL
from trendmill.workload.silver_cases import RAW_BACKFILL, RAW_LIVE
from trendmill.workload.tables import FACT_SQL, fresh_layout, over, portable, reference, silver, table


def _silver_rows(spark, layout):
    return silver_cases.rows_out(spark.table(layout.statistics))


def _backfill(spark, sf_dir):
    layout, path = fresh_layout(spark), fresh_path(spark, "csv")
    write_csv(over(spark, sf_dir, RAW_BACKFILL, "lineitem"), path, "region", rows_per_file=500_000)
    run_backfill(spark, path, layout)
    return _silver_rows(spark, layout)


# Bytes of the events that become six parts of a feed.
_BYTES_PER_PART = 64 * 1024 * 1024
# Bytes of the order lines that become one CSV file: a file with line breaks inside quotes is read by one task.
_BYTES_PER_FILE = 4 * 1024 * 1024


def _files(spark, rows, folder, n):
    """Write ``rows`` as at most ``n`` CSV files of fixed names, in place of what they were; returns the number of files.

    Rows that differ in nothing but counters and day lie in the same file, so a corrected row replaces the wrong one.
    """
    made = fresh_path(spark, "made")
    same = [F.col(c) for c in rows.columns if c not in ("views", "trending_date")]
    write_csv(rows.repartition(n, *same), made)
    parts = folder_names(spark, f"{made}/part-*.csv")
    for part in parts:
        store, place = file_system(spark, f"{folder}/history-{part.rsplit('/part-', 1)[1][:5]}.csv")
        store.mkdirs(place.getParent())
        store.delete(place, False)
        if not store.rename(file_system(spark, part)[1], place):
            raise AssertionError(f"{place} was not written")
    return len(parts)


def _two_folders(spark, sf_dir):
    """History in two folders of different regions. The first one's files are wrong at first: too large counters, rows that
    do not belong there, months that vanish; they are corrected in place and loaded again."""
    layout, folders = fresh_layout(spark), [fresh_path(spark, "csv"), fresh_path(spark, "csv")]
    rows = over(spark, sf_dir, RAW_BACKFILL, "lineitem")
    n = 1 + stored_bytes(spark, f"{sf_dir}/lineitem.parquet") // _BYTES_PER_FILE
    parts = [rows.filter("region = ' US'").drop("region"), rows.filter("region = 'Gb '").drop("region")]
    wrong = parts[0].withColumns({
        "views": F.lit("999999999"), "trending_date": F.when(F.length("video_id") % 2 == 0, F.lit("31.01.01")).otherwise(
            F.col("trending_date"))})
    _files(spark, wrong, f"{folders[0]}/region=us", n)
    run_backfill(spark, folders[0], layout)
    _files(spark, parts[1], f"{folders[1]}/region=GB", n)
    run_backfill(spark, folders[1], layout)
    corrected = _files(spark, parts[0], f"{folders[0]}/region=us", n)
    again = [run_backfill(spark, folder, layout)["files_read"] for folder in folders]
    if again != [corrected, 0]:
        raise AssertionError(f"files read again: {again}")
    return _silver_rows(spark, layout)


def _archived(spark, sf_dir):
    """A feed whose finished files move to an archive while more arrive, and the archive replayed into a Silver of its own."""
    layout, path, archive = fresh_layout(spark), fresh_path(spark, "live"), fresh_path(spark, "archive")
    state, rows = fresh_path(spark, "stream"), over(spark, sf_dir, RAW_LIVE, "events")
    for third in range(3):
        rows.filter(F.col("comment_count").cast("bigint") % 3 == third).write.mode("append").partitionBy("region").json(path)
        run_live(spark, path, layout, state, archive=archive)
    replayed = fresh_layout(spark)
    # The last batch's files are still in place: they move with the next batch.
    run_live(spark, archive + path.split(":", 1)[-1], replayed, fresh_path(spark, "stream"))
    run_live(spark, path, replayed, fresh_path(spark, "stream"))
    if not portable(spark.table(layout.statistics)).drop("_processed_at").exceptAll(
            portable(spark.table(replayed.statistics)).drop("_processed_at")).isEmpty():
        raise AssertionError("the archive gives other rows")
    return _silver_rows(spark, layout)


def _folded(spark, sf_dir):
    """Many batches, folded while they arrive and once more at the end; then Silver from what is left of landing."""
    layout, path = fresh_layout(spark), fresh_path(spark, "live")
    rows = over(spark, sf_dir, RAW_LIVE, "events")
    # As many batches at every size: more files in a larger feed, and as many times more in a batch.
    n = 1 + stored_bytes(spark, f"{sf_dir}/events.parquet") // _BYTES_PER_PART
    with small_scans(spark):
        rows.repartition(6 * n).write.partitionBy("region").json(path)
    run_live(spark, path, layout, fresh_path(spark, "stream"), files_per_batch=3 * n)
    fold(spark, layout, max_batches=1)
    closed = {}
    for place in partition_names(spark, layout.landing):
        closed[place[2:]] = closed.get(place[2:], 0) + 1
    if max(closed.values()) > 2:
        raise AssertionError("a partition has more than a folded and an open batch")
    rebuild_all(spark, layout)
    return _silver_rows(spark, layout)


def _live(spark, sf_dir):
    """All events as a live feed, taken in several batches."""
    layout, path = fresh_layout(spark), fresh_path(spark, "live")
    over(spark, sf_dir, RAW_LIVE, "events").write.partitionBy("region").json(path)
    run_live(spark, path, layout, fresh_path(spark, "stream"), files_per_batch=2)
    return _silver_rows(spark, layout)


def _two_feeds(spark, sf_dir):
    """Two feeds with checkpoints of their own; then the first one again from the start, with a new checkpoint."""
    layout, paths = fresh_layout(spark), [fresh_path(spark, "live"), fresh_path(spark, "live")]
    rows = over(spark, sf_dir, RAW_LIVE, "events")
    for path, wanted in zip(paths, ("even", "odd")):
        is_even = F.col("comment_count").cast("bigint") % 2 == 0
        rows.filter(is_even if wanted == "even" else ~is_even).write.partitionBy("region").json(path)
        run_live(spark, path, layout, fresh_path(spark, "stream"))
    return layout, paths


def _live_two_feeds(spark, sf_dir):
    layout, _ = _two_feeds(spark, sf_dir)
    return _silver_rows(spark, layout)


def _replay(spark, sf_dir):
    layout, paths = _two_feeds(spark, sf_dir)
    run_live(spark, paths[0], layout, fresh_path(spark, "stream"))
    return _silver_rows(spark, layout)


def _unreadable(spark, sf_dir):
    """One table whose folder has a file that is no Parquet, and one good table, checked together."""
    layout = fresh_layout(spark)
    write_full(silver(spark, sf_dir), layout.statistics, layout.path("clean_statistics"))
    overwrite_partitions(reference(spark, sf_dir), layout.reference, layout.path("clean_reference_data"))
    folder = layout.path("clean_reference_data") + "/region=asia"
    table(spark, sf_dir, "nation").select("n_name").write.mode("append").text(folder)
    spark.catalog.refreshTable(layout.reference)
    rules = Rules(critical={"clean_statistics": ("video_id", "views", "region"), "clean_reference_data": ("region",)})
    _, checks = check_silver(spark, layout, rules)
    return checks.select("check", "table", "column", "passed", F.col("check") == "read_table").toDF(
        "check", "table", "column", "passed", "unreadable").filter(F.col("check").isin("row_count", "read_table", "null_pct"))


def _reference_job(spark, sf_dir):
    """Category names as JSON lines, loaded twice: the second load replaces the regions it brings."""
    layout, path = fresh_layout(spark), fresh_path(spark, "reference")
    over(spark, sf_dir, silver_cases.RAW_REFERENCE, "events").write.json(path)
    for _ in range(2):
        run_reference(spark, path, layout)
    return spark.table(layout.reference).drop("_processed_at")


def _cycle(spark, sf_dir):
    """One scheduled run over all events: feed, names, gate and Gold; the gate has to pass."""
    layout, live, names = fresh_layout(spark), fresh_path(spark, "live"), fresh_path(spark, "reference")
    over(spark, sf_dir, RAW_LIVE, "events").write.partitionBy("region").json(live)
    over(spark, sf_dir, silver_cases.RAW_REFERENCE, "events").write.json(names)
    result = run_live_cycle(spark, live, names, layout, fresh_path(spark, "stream"), Rules(max_null_pct=100.0))
    if not result.quality_passed or not spark.catalog.tableExists(layout.table("trending_analytics")):
        raise AssertionError("Gold was not built")
    return _silver_rows(spark, layout)


def _with_missing_folders(spark, sf_dir):
    """A feed whose other source has no folder yet: it adds no rows and no error."""
    there = fresh_path(spark, "live")
    over(spark, sf_dir, RAW_LIVE, "events").write.partitionBy("region").json(there)
    rows = read_live(spark, there).unionByName(read_live(spark, fresh_path(spark, "nothing")))
    return silver_cases.rows_out(latest_statistics(cleanse_live(rows, "live")))


def _provenance(spark, sf_dir):
    """Rows by the job that made them, and how many have no time of processing."""
    rows = cleanse_backfill(over(spark, sf_dir, RAW_BACKFILL, "lineitem"), "history job")
    return latest_statistics(rows).groupBy("_job_name").agg(
        F.count("*").alias("n"), F.count_if(F.col("_processed_at").isNull()).alias("untimed"))


def _publish(spark, sf_dir, good_titles: bool):
    layout = fresh_layout(spark)
    title = F.when(F.lit(good_titles) | (F.col("views") > 0), F.col("channel_title"))
    rows = silver(spark, sf_dir).withColumns({"title": title, "_processed_at": F.current_timestamp()})
    write_full(rows, layout.statistics, layout.path("clean_statistics"))
    overwrite_partitions(reference(spark, sf_dir), layout.reference, layout.path("clean_reference_data"))
    return layout, build_gold_if_clean(spark, layout)


def _published(spark, sf_dir):
    layout, _ = _publish(spark, sf_dir, True)
    return portable(spark.table(layout.table("category_analytics")).drop("_aggregated_at"))


def _refused(spark, sf_dir):
    layout, result = _publish(spark, sf_dir, False)
    if spark.catalog.tableExists(layout.table("category_analytics")):
        raise AssertionError("Gold was built although a check failed")
    return result.failed.select("check", "table", "column", "value", "message")


_PAYLOADS = """
    select event_type as region, case when value < 100 then '{{"items": [{{"id"' else concat(
        '{{"items": [{{"id": "', event_id, '", "statistics": {{"viewCount": "', cast(value as bigint), '"}}}}, {{}}]}}') end as payload
    from {events}
"""


def _ingest(spark, sf_dir):
    """Payloads, some of them cut off, to Bronze files; the report per region and kind."""
    payloads = over(spark, sf_dir, _PAYLOADS, "events")
    return run_ingest(payloads, payloads, fresh_path(spark, "live"), fresh_path(spark, "reference"), INGESTED_AT)


def _published_table(name, *left_out):
    def query(spark, sf_dir):
        layout, _ = _publish(spark, sf_dir, True)
        return portable(spark.table(layout.table(name)).drop("_aggregated_at", *left_out))
    return query


_refreshed: dict[tuple[str, str], Layout] = {}


def _refreshed_layout(spark, sf_dir):
    """Gold from parts, twice. Between the builds January is corrected, March arrives and a month goes away; only those
    may be read for the second one. Made once per session and scale."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _refreshed:
        return _refreshed[key]
    layout = fresh_layout(spark)
    rows = silver(spark, sf_dir).withColumns({
        "_processed_at": F.current_timestamp(), "trending_month": fn.month_of(F.col("trending_date_parsed"))})
    month = F.substring("trending_month", 6, 2)
    early = rows.filter(month.isNull() | (month != "03")).withColumn("views", F.col("views") + F.when(month == "01", 7).otherwise(0))
    wrong = rows.filter(month == "02").withColumns({
        "trending_date_parsed": F.lit("2031-01-01").cast("date"), "trending_month": F.lit("2031-01")})
    path = layout.path("clean_statistics")
    write_full(early.unionByName(wrong), layout.statistics, path, SILVER_PARTITIONS)
    overwrite_partitions(reference(spark, sf_dir), layout.reference, layout.path("clean_reference_data"))
    refresh_gold(spark, layout)
    overwrite_partitions(rows.filter(month.isin("01", "03")), layout.statistics, path, SILVER_PARTITIONS)
    names = partition_names(spark, layout.statistics)
    drop_partitions(spark, layout.statistics, SILVER_PARTITIONS, {p: n for p, n in names.items() if p[1] == "2031-01"})
    changed = refresh_gold(spark, layout)
    if set(changed) != {p for p in names if (p[1] or "")[5:] in ("01", "03")}:
        raise AssertionError(f"read for the second build: {changed}")
    _refreshed[key] = layout
    return layout


def _refreshed_table(name):
    def query(spark, sf_dir):
        return portable(spark.table(_refreshed_layout(spark, sf_dir).table(name)).drop("_aggregated_at"))
    return query


QUERIES = {
    "gold_refresh_trending": _refreshed_table("trending_analytics"),
    "gold_refresh_channel": _refreshed_table("channel_analytics"),
    "gold_refresh_category": _refreshed_table("category_analytics"),
    "backfill_two_folders": _two_folders,
    "live_archive": _archived,
    "landing_fold": _folded,
    "live_cycle": _cycle,
    "empty_input": _with_missing_folders,
    "provenance": _provenance,
    "live_two_feeds": _live_two_feeds,
    "silver_replay": _replay,
    "dq_unreadable": _unreadable,
    "reference_job": _reference_job,
    "gated_trending": _published_table("trending_analytics"),
    "gated_channel": _published_table("channel_analytics"),
    "ingest_job": _ingest,
    "backfill_job": _backfill,
    "live_stream": _live,
    "gated_publish": _published,
    "gate_refuses": _refused,
}

SQL = {
    "gold_refresh_trending": GOLD_SQL["gold_trending"],
    "gold_refresh_channel": GOLD_SQL["gold_channel"],
    "gold_refresh_category": GOLD_SQL["gold_category"],
    "backfill_two_folders": silver_cases.SQL["backfill_silver"],
    "live_archive": silver_cases.SQL["dedup_live"],
    "landing_fold": silver_cases.SQL["dedup_live"],
    "live_cycle": silver_cases.SQL["dedup_live"],
    "empty_input": silver_cases.SQL["dedup_live"],
    "provenance": f"""
        select 'history job' as _job_name, count(*) as n, cast(0 as bigint) as untimed
        from ({silver_cases.SQL["backfill_silver"]})
    """,
    "live_two_feeds": silver_cases.SQL["dedup_live"],
    "silver_replay": silver_cases.SQL["dedup_live"],
    "dq_unreadable": f"""
        select * from (values ('row_count', null), ('null_pct', 'video_id'), ('null_pct', 'views'), ('null_pct', 'region'))
                      as c("check", "column"),
             (select 'clean_statistics' as "table", count(*) >= 10 as passed, false as unreadable from ({FACT_SQL}))
        union all by name
        select 'read_table' as "check", 'clean_reference_data' as "table", null as "column", false as passed,
               true as unreadable
    """,
    "reference_job": silver_cases.SQL["silver_reference_clean"],
    "gated_trending": GOLD_SQL["gold_trending"],
    "gated_channel": GOLD_SQL["gold_channel"],
    "ingest_job": """
        select event_type as region, kind, count(*) filter (where value >= 100) as payloads_ok,
               count(*) filter (where value < 100) as payloads_bad,
               2 * count(*) filter (where value >= 100) as items,
               count(*) filter (where value < 100) = 0 as succeeded
        from events, (values ('trending'), ('categories')) as k(kind) group by event_type, kind
    """,
    "backfill_job": silver_cases.SQL["backfill_silver"],
    "live_stream": silver_cases.SQL["dedup_live"],
    "gated_publish": GOLD_SQL["gold_category"],
    "gate_refuses": f"""
        select 'null_pct' as "check", 'clean_statistics' as "table", 'title' as "column", round(percent, 2) as value,
               printf('%.2f %% of title are empty, 5.0 %% allowed', percent) as message
        from (select count(*) filter (where views <= 0) * 1.0 / count(*) * 100 as percent from ({FACT_SQL}))
    """,
}
