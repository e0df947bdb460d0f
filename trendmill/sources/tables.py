"""Catalog tables: full writes and partition overwrites."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmill.operators.cleanse import align_columns
from trendmill.session import byte_setting, remove_folder, settings
from trendmill.sources.bronze_csv import NOTHING_THERE

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Rows of a file: a scan cannot cut a small file into pieces, however many rows it has.
RECORDS_PER_FILE = 1_000_000
# Shuffled bytes that a task writes, so that tables of a few partitions are written by many tasks as well.
WRITTEN_BYTES = 16 * 1024 * 1024


@dataclass(frozen=True)
class Layout:
    """Where a deployment keeps its tables."""

    root: str
    database: str = "default"

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    statistics = property(lambda self: self.table("clean_statistics"))
    reference = property(lambda self: self.table("clean_reference_data"))
    landing = property(lambda self: self.table("landing_statistics"))
    files = property(lambda self: self.table("landing_files"))


@contextmanager
def overwrite_mode(spark: SparkSession, mode: str):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def sized_files(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Bring rows of a partition together, but let adaptive execution split a large one over several tasks."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def columns_sql(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def ensure_table(spark: SparkSession, table: str, path: str, schema: T.StructType, partition_by: tuple[str, ...]) -> None:
    """Have a catalog entry over whatever the folder holds, so that a lost entry neither hides nor drops rows.

    Columns that only the files know are kept.
    """
    if spark.catalog.tableExists(table):
        return
    fields, there = {f.name: f for f in schema.fields}, False
    try:
        for field in spark.read.parquet(path).schema.fields:
            fields.setdefault(field.name, field)
        there = True
    except AnalysisException as error:
        if error.getCondition() not in NOTHING_THERE:
            raise
    parts = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(f"CREATE TABLE {table} ({columns_sql(T.StructType(list(fields.values())))}) USING parquet "
              f"PARTITIONED BY ({parts}) LOCATION '{path}'")
    if there:
        spark.catalog.recoverPartitions(table)


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_names(spark: SparkSession, table: str, **fixed) -> dict[tuple, str]:
    """{values: folder name} of the partitions in the catalog, as text; ``fixed`` limits some of the keys.

    Names only: no file is opened, so the cost does not depend on how much the partitions hold.
    """
    spec = ", ".join(f"`{key}` = {_sql_text(str(value))}" for key, value in fixed.items())
    rows = spark.sql(f"SHOW PARTITIONS {table}" + (f" PARTITION ({spec})" if spec else "")).collect()
    names = {}
    for row in rows:
        values = [unquote(part.split("=", 1)[1]) for part in row[0].split("/")]
        names[tuple(None if v == _NULL_PARTITION else v for v in values)] = row[0]
    return names


def drop_partitions(spark: SparkSession, table: str, keys: tuple[str, ...], gone: dict[tuple, str]) -> None:
    """Take partitions out of the catalog, then delete their folders."""
    if not gone:
        return
    root = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()["data_type"]
    specs = [", ".join(f"`{k}` = {_sql_text(_NULL_PARTITION if v is None else v)}" for k, v in zip(keys, values))
             for values in gone]
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({spec})" for spec in specs))
    for name in gone.values():
        remove_folder(spark, f"{root.rstrip('/')}/{name}")
    spark.catalog.refreshTable(table)


def insert_partitions(
    df: DataFrame, table: str, partition_by: tuple[str, ...], rebalance: bool = True
) -> tuple[set[tuple], int]:
    """Replace the partitions that occur in ``df``; returns their values as text, and the number of rows.

    The new files are complete before the first partition changes; partitions then change one after the other.
    """
    spark = df.sparkSession
    add_new_columns(spark, table, df)
    rows = align_columns(df, spark.table(table).schema)
    rows = sized_files(rows, partition_by) if rebalance else rows
    seen = Observation()
    rows = rows.observe(seen, F.collect_set(F.struct(*partition_by)).alias("partitions"), F.count(F.lit(1)).alias("rows"))
    advised = byte_setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    with overwrite_mode(spark, "dynamic"), settings(
            spark, spark__sql__files__maxRecordsPerFile=RECORDS_PER_FILE,
            spark__sql__adaptive__advisoryPartitionSizeInBytes=min(advised, WRITTEN_BYTES)):
        rows.write.insertInto(table, overwrite=True)
    # Empty text and null share a folder.
    return {tuple(None if v in (None, "") else str(v) for v in p) for p in seen.get["partitions"]}, seen.get["rows"]


def write_full(
    df: DataFrame, table: str, path: str, partition_by: tuple[str, ...] = ("region",), rebalance: bool = True
) -> None:
    """Replace all rows of a table: Parquet, Snappy, partitioned, registered in the catalog.

    A build that fails before its files are complete leaves the old rows as they were, and the table never goes away.
    Partitions change one after the other, those without rows last; ``published.publish`` is for tables whose readers
    must not see that. A column the table has and ``df`` lacks is null.
    """
    spark = df.sparkSession
    ensure_table(spark, table, path, df.schema, partition_by)
    before = partition_names(spark, table)
    after, _ = insert_partitions(df, table, partition_by, rebalance)
    drop_partitions(spark, table, partition_by, {p: name for p, name in before.items() if p not in after})


def add_new_columns(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Widen the table by columns it does not have yet; older files read as null there."""
    known = set(spark.table(table).columns)
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")


def overwrite_partitions(
    df: DataFrame, table: str, path: str, partition_by: tuple[str, ...] = ("region",)
) -> int:
    """Replace only the partitions that occur in ``df`` and return their number; the table is made or widened if needed."""
    ensure_table(df.sparkSession, table, path, df.schema, partition_by)
    return len(insert_partitions(df, table, partition_by)[0])


def read_or_none(spark: SparkSession, table: str) -> DataFrame | None:
    return spark.table(table) if spark.catalog.tableExists(table) else None
