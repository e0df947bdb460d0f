"""What the operators share: staging in the shared folder, free column names, row ranks, reading vocabularies."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyarrow import fs as pa_fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendmill.operators.broadcasting import broadcast_if_small
from trendmill.session import fresh_path

# ASCII white space, the only characters that separate words.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_recorded: list[list[str]] = []


@contextmanager
def recording() -> Iterator[list[str]]:
    """The folders that operators make while the context is open, for whoever knows when they are no longer read."""
    made: list[str] = []
    _recorded.append(made)
    try:
        yield made
    finally:
        _recorded.remove(made)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, recorded where somebody keeps record."""
    path = fresh_path(spark, label)
    for made in _recorded:
        made.append(path)
    return path


def stage(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends, and executors may be lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_store(path: str) -> tuple[pa_fs.FileSystem, str]:
    """The file system of a shared folder, as tasks use it for files of their own, and the folder's name there."""
    if path.startswith("file:"):
        return pa_fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return pa_fs.LocalFileSystem(), path
    return pa_fs.FileSystem.from_uri(path)


def vocabulary(name: str) -> str:
    """The place of a public tokenizer file, as installed on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """Column names that the input does not use (Spark compares names without case)."""
    used = {name.lower() for name in taken}
    names = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        names.append(name)
    return names


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Add a unique number per row. Stage the result before a second job reads it: only then is it stable."""
    return df.withColumn(name, F.monotonically_increasing_id())


def let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def place_in_order(rows: DataFrame, order: list[Column], weight: str | None = None) -> DataFrame:
    """``rows`` with ``rank``, their place among the rows of their key ``k`` (from 0), and ``total``, how many the key has.

    With ``weight`` also ``before``, the sum of that long column over the rows of the key that come earlier.

    A key that holds a third of all rows spans many tasks: rows are range-partitioned by key and ``order``, and what a row
    has before it in its own task is raised by what its key has in earlier tasks. The placement is written before it is
    counted, so both see the same. ``order`` has to be total but for rows that are equal.
    """
    by = [F.col("k").asc(), *order]
    placed = stage(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumns(
        {"slot": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "placed", "zstd")
    summed = {"n": F.count("*"), "sum": F.sum(F.col(weight) if weight else F.lit(0))}
    slots = placed.groupBy("slot", "k").agg(F.min("place").alias("first"), *[c.alias(n) for n, c in summed.items()])
    of_key = Window.partitionBy("k")
    earlier = of_key.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    shifts = slots.select(
        "slot", "k", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("skipped"), F.sum("n").over(of_key).alias("total"))
    joined = placed.join(broadcast_if_small(shifts), ["slot", "k"])
    names = [*rows.columns, (F.col("place") + F.col("shift")).alias("rank"), "total"]
    if weight:
        in_slot = Window.partitionBy("slot", "k").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        names.append((F.col("skipped") + F.coalesce(F.sum(weight).over(in_slot), F.lit(0))).alias("before"))
    return joined.select(*names)
