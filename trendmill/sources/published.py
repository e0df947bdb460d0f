"""Tables that readers see one version of at a time.

A build writes a version: a folder and a catalog table of its own. Readers use a view under the table's name; it is
changed to the new version in one catalog operation once all files are there. A query that was planned before keeps
reading the old version, which stays for a while. A merge makes a version of new rows and of what the old version holds
for other keys; its cost is that of the rows, however many keys there are.
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmill.operators.cleanse import align_columns
from trendmill.session import folder_names, remove_folder
from trendmill.sources.tables import columns_sql, ensure_table, sized_files

KEEP_VERSIONS = 2
_VERSION = re.compile(r"v\d{20}_[0-9a-f]{8}")
_POINTER = "published.version"


def _version_table(table: str, version: str) -> str:
    return f"{table}__{version}"


def write_version(df: DataFrame, table: str, path: str, partition_by: tuple[str, ...] = ("region",)) -> str:
    """Write ``df`` as a new version that nobody sees yet; returns its name. Names sort by time."""
    version = _new_name()
    sized_files(df, partition_by).write.partitionBy(*partition_by).parquet(f"{path}/{version}")
    _register(df.sparkSession, table, version, path, df.schema, partition_by)
    return version


def _new_name() -> str:
    return f"v{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"


def _register(
    spark: SparkSession, table: str, version: str, path: str, schema: T.StructType, partition_by: tuple[str, ...] = ()
) -> None:
    parts = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_version_table(table, version)} ({columns_sql(schema)}) USING parquet "
              + (f"PARTITIONED BY ({parts}) " if parts else "") + f"LOCATION '{path}/{version}'")
    if parts:
        spark.catalog.recoverPartitions(_version_table(table, version))


def point_to(spark: SparkSession, table: str, version: str) -> None:
    """Let readers see a version, a new one or an earlier one that is still there: one change of the catalog.

    A plain table of that name, from before there were versions, becomes the oldest one.
    """
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {table} RENAME TO {_version_table(table, 'v0')}")
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('{_POINTER}' = '{version}') "
              f"AS SELECT * FROM {_version_table(table, version)}")


def current_version(spark: SparkSession, table: str) -> str | None:
    """The version readers see; None if nothing is published."""
    if not spark.catalog.tableExists(table) or spark.catalog.getTable(table).tableType != "VIEW":
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(f"key = '{_POINTER}'").first()
    return None if found is None else found["value"]


def versions(spark: SparkSession, path: str) -> list[str]:
    """The versions that have a folder, oldest first, unfinished ones included."""
    names = [place.rstrip("/").rsplit("/", 1)[1] for place in folder_names(spark, f"{path}/v*")]
    return sorted(name for name in names if _VERSION.fullmatch(name))


def remove_old_versions(spark: SparkSession, table: str, path: str, keep: int = KEEP_VERSIONS) -> list[str]:
    """Remove what is older than the version readers see, but for the ``keep - 1`` newest of it; returns the names.

    A newer version may be one that is just being written, so it stays.
    """
    current = current_version(spark, table)
    older = [] if current is None else [v for v in versions(spark, path) if v < current]
    gone = older[:max(0, len(older) - (keep - 1))]
    for version in gone:
        spark.sql(f"DROP TABLE IF EXISTS {_version_table(table, version)}")
        remove_folder(spark, f"{path}/{version}")
    return gone


def publish(
    df: DataFrame, table: str, path: str, partition_by: tuple[str, ...] = ("region",), keep: int = KEEP_VERSIONS
) -> str:
    """Replace all rows of a table for its readers at once; a build that fails changes nothing for them."""
    version = write_version(df, table, path, partition_by)
    point_to(df.sparkSession, table, version)
    remove_old_versions(df.sparkSession, table, path, keep)
    return version


def _merged_before(spark: SparkSession, table: str, path: str, schema: T.StructType, key: str) -> DataFrame | None:
    """What readers see; if the catalog entry is lost, it is made again over the newest complete version.

    Folders of single keys, from before there were versions, count if there is no version.
    """
    if not spark.catalog.tableExists(table):
        whole = [v for v in versions(spark, path) if folder_names(spark, f"{path}/{v}/_SUCCESS")]
        if whole:
            _register(spark, table, whole[-1], path, spark.read.parquet(f"{path}/{whole[-1]}").schema)
            point_to(spark, table, whole[-1])
        elif folder_names(spark, f"{path}/{key}=*"):
            ensure_table(spark, table, path, schema, (key,))
        else:
            return None
    return spark.table(table)


def merge(df: DataFrame, table: str, path: str, key: str = "region", keep: int = KEEP_VERSIONS) -> str | None:
    """Replace the rows of the keys that occur in ``df`` for readers at once; returns the version, None if there are no rows.

    The new version has the rows of ``df`` and those of all other keys, in files without a folder per key. The new rows are
    written first and the keys read back from them, so ``df`` is computed once. Empty text and null are one key, null.
    A column only one side has is null in the other's rows.
    """
    spark, version, seen = df.sparkSession, _new_name(), Observation()
    rows, folder = df.withColumn(key, F.nullif(F.col(key), F.lit(""))), f"{path}/{version}"
    old = _merged_before(spark, table, path, df.schema, key)
    names = [c for c in df.columns if c != key]
    more = [] if old is None else [f for f in old.schema.fields if f.name not in df.columns]
    schema = T.StructType([*[df.schema[c] for c in names], *more, df.schema[key]])
    # Only a version that has all its rows is marked as complete.
    mark = str(old is None).lower()
    sized_files(align_columns(rows, schema), ()).observe(seen, F.count(F.lit(1)).alias("rows")) \
        .write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", mark).parquet(folder)
    if not seen.get["rows"]:
        remove_folder(spark, folder)
        return None
    if old is not None:
        brought = spark.read.schema(schema).parquet(folder).select(F.col(key).alias("_brought")).distinct()
        others = old.join(brought, F.col(key).eqNullSafe(F.col("_brought")), "left_anti")
        sized_files(align_columns(others, schema), ()).write.mode("append").parquet(folder)
    _register(spark, table, version, path, schema)
    point_to(spark, table, version)
    remove_old_versions(spark, table, path, keep)
    return version
