"""Live feed and category reference: JSON lines below ``region=/date=/hour=`` folders."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trendmill.operators.broadcasting import broadcast_if_small
from trendmill.schemas import CORRUPT, LIVE_FIELDS, REFERENCE_FIELDS, all_strings
from trendmill.session import enable_checkpoints, folder_names, remove_folder
from trendmill.sources.bronze_csv import NOTHING_THERE

FILES = "*.json"
GZIP_FILES = "*.json.gz"
RECORDS_PER_GZIP = 1_000_000
# The folder of rows without a region.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def parse_lines(lines: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """``value`` column of JSON text to text columns; blank lines are skipped, bad ones keep their text.

    A region taken from the path stays, and wins over a region inside the line.
    """
    schema = all_strings((*fields, CORRUPT))
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    others = [c for c in lines.columns if c != "value"]
    rows = lines.filter(F.col("value").rlike(r"\S")).withColumn("_row", parsed)
    inside = [F.col(f"_row.{name}").alias(name) for name in (*fields, CORRUPT) if name not in others]
    return rows.select(*inside, *others)


def drop_bad_files(rows: DataFrame) -> DataFrame:
    """Remove every row of a file (``_file``) that has at least one bad line."""
    enable_checkpoints(rows.sparkSession)
    bad = rows.filter(F.col(CORRUPT).isNotNull()).select("_file").distinct().checkpoint()
    return rows.join(broadcast_if_small(bad), "_file", "left_anti")


def _read(
    spark: SparkSession, path: str, fields: tuple[str, ...], on_bad_record: str, keep_corrupt: bool, files: str,
    skip_unreadable: bool,
) -> DataFrame:
    columns = [*fields, CORRUPT] if keep_corrupt else list(fields)
    found = spark.read.options(pathGlobFilter=files, ignoreCorruptFiles=str(skip_unreadable).lower())
    try:
        if on_bad_record == "drop_file":
            lines = found.text(path)
            extra = [F.col("region").cast("string").alias("region")] if "region" in lines.columns else []
            lines = lines.select("value", F.col("_metadata.file_path").alias("_file"), *extra)
            return drop_bad_files(parse_lines(lines, fields)).select(*columns)
        reader = found.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        return reader.schema(all_strings(columns)).json(path).select(*columns)
    except AnalysisException as error:
        if error.getCondition() in NOTHING_THERE:
            return spark.createDataFrame([], all_strings(columns))
        raise


def read_live(
    spark: SparkSession, path: str, on_bad_record: str = "drop_line", keep_corrupt: bool = False,
    files: str = FILES, skip_unreadable: bool = False,
) -> DataFrame:
    """Live rows, every scalar as text.

    ``on_bad_record="drop_line"``: a line that is no JSON becomes a row of nulls, which cleaning drops;
    ``keep_corrupt`` adds its text for counting. ``"drop_file"``: all lines of its file are dropped.
    A missing folder gives no rows. A file that cannot be read at all (a broken archive) fails the read;
    with ``skip_unreadable`` it is skipped, as far as it could not be read.
    """
    return _read(spark, path, LIVE_FIELDS, on_bad_record, keep_corrupt, files, skip_unreadable)


def read_reference(
    spark: SparkSession, path: str, on_bad_record: str = "drop_line", keep_corrupt: bool = False,
    files: str = FILES, skip_unreadable: bool = False,
) -> DataFrame:
    """Category rows, every scalar as text; options as for ``read_live``."""
    return _read(spark, path, REFERENCE_FIELDS, on_bad_record, keep_corrupt, files, skip_unreadable)


def write_bronze(
    rows: DataFrame, path: str, ingested_at: str, hourly: bool = True, run_id: str | None = None, compression: str | None = None,
) -> None:
    """JSON lines below region/date(/hour/run) of the ingestion time; nulls are written, text stays UTF-8.

    A run that is repeated replaces what it wrote: hourly files lie below ``run=<run_id>`` (by default the ingestion
    time), beside those of other runs of the hour, and regions the repeated run no longer has lose their files. Daily
    files have one version per region and day, the last.

    ``compression="gzip"`` writes ``*.json.gz``, which the readers take with ``files=GZIP_FILES``. Such a file is read by
    one task, so it holds no more than RECORDS_PER_GZIP lines. A folder should have files of one kind.
    """
    spark = rows.sparkSession
    packed = {"compression": compression, "maxRecordsPerFile": RECORDS_PER_GZIP} if compression else {}
    time = F.to_timestamp(F.lit(ingested_at))
    run = re.sub(r"[^0-9A-Za-z]+", "-", run_id or ingested_at)
    parts = {"date": F.date_format(time, "yyyy-MM-dd")}
    if hourly:
        parts |= {"hour": F.date_format(time, "HH"), "run": F.lit(run)}
    seen = Observation()
    (
        rows.withColumns(parts)
        .observe(seen, F.collect_set(F.coalesce("region", F.lit(""))).alias("regions"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(ignoreNullFields="false", **packed)
        .partitionBy("region", *parts)
        .json(path)
    )
    if hourly:
        written = {region or NULL_FOLDER for region in seen.get["regions"]}
        day, hour = spark.range(1).select(parts["date"], parts["hour"]).first()
        for folder in folder_names(spark, f"{path}/region=*/date={day}/hour={hour}/run={run}"):
            if unquote(re.search(r"/region=([^/]*)/", folder).group(1)) not in written:
                remove_folder(spark, folder)
