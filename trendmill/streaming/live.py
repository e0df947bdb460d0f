"""Live JSON lines to Silver with Structured Streaming.

Every run takes the files that arrived since the last one (``availableNow``), lands them under the
feed's and the batch's id and, when all batches have landed, rebuilds the touched Silver partitions. There is no
watermark: a late file is still welcome, and the ingestion time inside the rows decides which row of a key is newest. A
batch that is repeated after a failure replaces itself. Each batch notes which partitions it touches before it counts as
done, so those of a run that dies are rebuilt by the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendmill.operators.audit import counted
from trendmill.operators.cleanse import cleanse_live
from trendmill.schemas import CORRUPT, LIVE_FIELDS, all_strings
from trendmill.session import use_job_settings
from trendmill.sources.bronze_json import FILES, drop_bad_files, parse_lines
from trendmill.sources.landing import catch_up, fold, land, postpone, rebuild
from trendmill.sources.tables import Layout

JOB = "live"
# Folder levels of the feed besides region; a feed may lack some of them.
_FOLDERS = ("date", "hour", "run")


def live_source(
    spark: SparkSession, path: str, on_bad_record: str = "drop_line", files_per_batch: int | None = None,
    files: str = FILES, archive: str | None = None,
) -> DataFrame:
    """The feed as a stream: text columns of LIVE_FIELDS plus the text of bad lines.

    The file source would skip files much older than the newest one; here no file is too old. With ``archive``, files
    move to that folder once a later batch is done with, so the listing of a run does not grow with the feed.
    """
    reader = spark.readStream.options(pathGlobFilter=files, maxFileAge="36500d")
    if archive:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if on_bad_record == "drop_file":
        lines = reader.schema(all_strings(("value", "region", *_FOLDERS))).text(path)
        lines = lines.select("value", "region", F.col("_metadata.file_path").alias("_file"))
        return parse_lines(lines, LIVE_FIELDS)
    columns = (*LIVE_FIELDS, CORRUPT)
    reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    return reader.schema(all_strings((*columns, *_FOLDERS))).json(path).select(*columns)


def load_batch(
    raw: DataFrame, layout: Layout, batch_id: int, feed: str = JOB, job_name: str = JOB,
    missing_category: int | None = 0, later: bool = False,
) -> dict:
    """Land one batch of a feed and rebuild what it touches; returns the row counts of the landing.

    With ``later``, what it touches is only noted, for ``landing.catch_up`` to rebuild.
    """
    read = Observation()
    if "_file" in raw.columns:
        raw = drop_bad_files(raw)
    raw = counted(raw, read, bad=F.count_if(F.col(CORRUPT).isNotNull()))
    landed, changed = land(cleanse_live(raw, job_name, missing_category), layout, feed, batch_id)
    counts = {"batch_id": batch_id, "rows_read": read.get["rows"], "rows_bad": read.get["bad"], "rows_landed": landed}
    if changed and later:
        postpone(raw.sparkSession, layout, changed)
    elif changed:
        rebuild(raw.sparkSession, layout, changed)
    return counts


def run_live(
    spark: SparkSession, path: str, layout: Layout, checkpoint: str, on_bad_record: str = "drop_line",
    files_per_batch: int | None = None, missing_category: int | None = 0,
    on_counts: Callable[[dict], None] | None = None, files: str = FILES, archive: str | None = None,
) -> StreamingQuery:
    """Process every file that has arrived; returns when the stream has caught up.

    However many batches that takes, Silver is rebuilt once, after the last one, and also if one fails.

    ``archive``: a folder on the same store, outside ``path``, that takes the files of finished batches. They keep their
    place below it, so it can be replayed like any feed.
    """
    use_job_settings(spark)

    def process(raw: DataFrame, batch_id: int) -> None:
        # The query's id is kept in its checkpoint: batch numbers are unique within it and only there.
        feed = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        counts = load_batch(raw, layout, batch_id, feed, missing_category=missing_category, later=True)
        if on_counts:
            on_counts(counts)

    query = (
        live_source(spark, path, on_bad_record, files_per_batch, files, archive)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        catch_up(spark, layout)
    fold(spark, layout)
    if spark.catalog.tableExists(layout.statistics):
        spark.catalog.refreshTable(layout.statistics)  # batches run in a session of their own
    return query
