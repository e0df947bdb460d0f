"""row_number over groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendmill.operators.broadcasting import broadcast_if_small
from trendmill.session import enable_checkpoints

_ROW_IN_SLOT = (1 << 33) - 1


def row_number_by_range(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``row_number() over (partition by group order by order)`` without one task per group.

    A window would sort a whole group in one task, and one group may hold a third of all rows. Here the
    rows are range-partitioned on (group, order), so a large group spans many tasks. A row's number is
    its place inside its slot plus the rows its group has in earlier slots. ``order`` has to be total.

    The placement is checkpointed: range bounds come from a sample, and the slot sizes and the rows must
    see the same bounds. The slot table has at most (slots + groups) rows.
    """
    enable_checkpoints(df.sparkSession)
    keys = [F.col(group).asc_nulls_first(), *order]
    place = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumns({"_slot": F.spark_partition_id(), "_place": place.bitwiseAND(F.lit(_ROW_IN_SLOT))})
        .checkpoint()
    )
    slots = placed.groupBy("_slot", group).agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy(group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    shifts = slots.select(
        F.col("_slot").alias("_s"),
        F.col(group).alias("_g"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = (F.col("_slot") == F.col("_s")) & F.col(group).eqNullSafe(F.col("_g"))
    return (
        placed.join(broadcast_if_small(shifts), same, "inner")
        .withColumn(name, (F.col("_place") + F.col("_shift")).cast("int"))
        .select(*df.columns, name)
    )
