"""Row numbers within groups, without sorting a whole group on one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradegrain.session import settle

# monotonically_increasing_id() holds the partition above these bits, the row below them.
_ROW_BITS = 33


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[str | Column],
                position: str = "position", size: str = "group_size") -> DataFrame:
    """Add each row's 0-based position within its group, and the group's size.

    `order` must be total within a group, so that ties cannot fill one range partition: then
    a group with most of the rows is spread over many tasks by the sort. The sorted rows are
    written with their place in the sort; from that table, each task's first place and row
    count per group are a small table (one row per task and group), whose running sum gives
    where the task's rows start within the group. Being read from a written table, both sides
    see the same places even when tasks are run again.
    """
    placed = settle(df.orderBy(*group, *order)
                      .withColumn("_place", F.monotonically_increasing_id()), "sorted")
    task = F.shiftright("_place", _ROW_BITS)
    runs = (placed.groupBy(*group, task.alias("_task"))
            .agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")))
    within = Window.partitionBy(*(group or [F.lit(0)]))
    before = within.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(runs.select(
        *[F.col(g).alias(f"_in_{g}") for g in group], "_task",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(within).alias(size)), "starts")

    same = task == F.col("_task")
    for g in group:
        same = same & F.equal_null(F.col(g), F.col(f"_in_{g}"))
    return (placed.join(starts, same)
            .select(*df.columns, (F.col("_place") + F.col("_shift")).alias(position), size))
