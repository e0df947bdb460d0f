"""The ledger of source files: which version of a file has landed, in which batch, and in which partitions.

A file is known by its path; it has changed if its size or time has. Each backfill lands what is new or changed as one
batch and enters it here last, so a run that dies leaves the files as they were known, and the next run takes them
again under the same batch number. Rows of older versions stay in landing and are left out of every rebuild.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendmill.operators.cleanse import filter_regions
from trendmill.schemas import FILES_PARTITIONS, LANDED_FILES, SILVER_PARTITIONS
from trendmill.sources.bronze_csv import NOTHING_THERE
from trendmill.sources.tables import Layout, ensure_table, insert_partitions, read_or_none

# File names that a scan is given one by one; longer lists are joined instead.
MAX_NAMED_FILES = 10_000


def find_files(spark: SparkSession, path: str, regions: Collection[str] | None = None) -> DataFrame:
    """(file, size, modified) of the files below ``path``, from their listing; no file is read.

    With ``regions``, files below other ``region=`` folders are left out, and so are files outside such folders: whose
    rows they hold is not known before they are read.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as error:
        if error.getCondition() in NOTHING_THERE:
            return spark.createDataFrame([], "file string, size bigint, modified timestamp")
        raise
    found = files.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"))
    if regions is None:
        return found
    named = found.withColumn("region", F.regexp_extract("file", r"region=([^/]+)/", 1))
    return filter_regions(named, regions).drop("region")


def entries(spark: SparkSession, layout: Layout) -> DataFrame:
    """All versions of all files that have landed."""
    known = read_or_none(spark, layout.files)
    return spark.createDataFrame([], LANDED_FILES) if known is None else known


def next_batch(known: DataFrame, feed: str) -> int:
    return (known.filter(F.col("feed") == feed).agg(F.max("batch_id")).first()[0] or 0) + 1


def newest(known: DataFrame) -> DataFrame:
    """The version of every file that counts."""
    return known.groupBy("file").agg(F.max_by(F.struct("size", "modified", "batch_id", "partitions"), "batch_id").alias("v")) \
        .select("file", "v.*")


def changed_files(found: DataFrame, known: DataFrame) -> DataFrame:
    """Files that have not landed as they are now."""
    return found.join(newest(known).select("file", "size", "modified"), ["file", "size", "modified"], "left_anti")


def superseded(known: DataFrame) -> DataFrame:
    """(source_file, origin_batch) of versions that a later one has replaced."""
    later = F.max("batch_id").over(Window.partitionBy("file"))
    return known.select("file", "batch_id", later.alias("last")).filter("batch_id < last") \
        .select(F.col("file").alias("source_file"), F.col("batch_id").alias("origin_batch"))


def old_partitions(changed: DataFrame, known: DataFrame) -> set[tuple]:
    """The (region, month) partitions that hold rows of earlier versions of these files: names, not data."""
    parts = newest(known).join(changed.select("file"), "file", "left_semi").select(F.explode("partitions").alias("p"))
    return {tuple(r) for r in parts.select("p.*").distinct().collect()}


def entries_of_batch(changed: DataFrame, landed: DataFrame, feed: str, batch_id: int) -> DataFrame:
    """The ledger rows of a batch: every changed file, with the partitions and the number of its landed rows.

    A file without a single usable row is entered too; its earlier rows no longer count.
    """
    found = landed.groupBy(F.col("source_file").alias("file")).agg(
        F.count("*").alias("rows"),
        F.collect_set(F.struct(*SILVER_PARTITIONS)).alias("partitions"))
    rows = changed.join(found, "file", "left").withColumns({
        "rows": F.coalesce("rows", F.lit(0).cast("bigint")), "feed": F.lit(feed), "batch_id": F.lit(batch_id).cast("bigint"),
        "partitions": F.coalesce("partitions", F.array().cast(LANDED_FILES["partitions"].dataType))})
    return rows.select(LANDED_FILES.fieldNames())


def record(batch: DataFrame, layout: Layout) -> None:
    """Enter a batch: from now on its versions of the files are the ones that count."""
    spark = batch.sparkSession
    ensure_table(spark, layout.files, layout.path("landing/files"), LANDED_FILES, FILES_PARTITIONS)
    insert_partitions(batch, layout.files, FILES_PARTITIONS)
