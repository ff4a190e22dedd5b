"""RANK, PERCENT_RANK and CUME_DIST, unrounded, over whole tables or within giant groups.

Rows are sorted by group, value and a tie column, so that a value that a third of the rows share is
spread over many tasks. Where such a run of ties begins and ends is known within a task; across
tasks it is carried by a scan over one row per task. No task holds a group or a value, and there is
no array of levels, so values may have any number of decimals and any type that sorts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradegrain.operators.numbering import _ROW_BITS
from tradegrain.session import settle


def add_ranks(df: DataFrame, value: str, tie: str, group: Sequence[str] = (),
              prefix: str = "") -> DataFrame:
    """Add `rank` (long), `percent_rank` and `cume_dist` of the ascending `value`, NULLs first,
    within `group`. `tie` is a unique column; it only spreads equal values."""
    task = F.shiftright("_place", _ROW_BITS)
    placed = settle(df.orderBy(*group, value, tie)
                      .withColumn("_place", F.monotonically_increasing_id()), "sorted")
    run = Window.partitionBy("_task", *group, value)
    runs = settle(placed.withColumn("_task", task).withColumns({
        "_from": F.min("_place").over(run), "_to": F.max("_place").over(run)}), "runs")

    key = F.struct(*group, value)
    tasks = runs.groupBy("_task").agg(
        F.count(F.lit(1)).alias("rows"), F.min("_place").alias("low"), F.max("_place").alias("high"),
        F.min_by(key, "_place").alias("first_key"), F.max_by(key, "_place").alias("last_key"),
        F.min_by("_to", "_place").alias("first_ends"),
        F.max_by("_from", "_place").alias("last_starts"))
    # From here to the join: one row per task of the sort.
    order = Window.partitionBy(F.lit(0)).orderBy("_task")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(1, Window.unboundedFollowing)
    shift = F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("low")
    linked = tasks.select("*", shift.alias("shift")).withColumns({
        "goes_on": F.coalesce(F.equal_null("first_key", F.lag("last_key").over(order)), F.lit(False))
        & F.lag("_task").over(order).isNotNull(),
        "is_followed": F.coalesce(F.equal_null("last_key", F.lead("first_key").over(order)),
                                  F.lit(False)) & F.lead("_task").over(order).isNotNull(),
        "one_run": F.equal_null("first_key", "last_key")})
    # A task that is all one run hands on what it was handed.
    starts = F.when(~(F.col("one_run") & F.col("goes_on")), F.col("last_starts") + F.col("shift"))
    ends = F.when(~(F.col("one_run") & F.col("is_followed")), F.col("first_ends") + F.col("shift"))
    carried = settle(linked.select(
        "_task", "low", "high", "shift",
        F.when(F.col("goes_on"), F.last(starts, True).over(earlier)).alias("carried_from"),
        F.when(F.col("is_followed"), F.first(ends, True).over(later)).alias("carried_to")), "carried")

    parts = (runs.groupBy(*group, "_task").agg(F.min("_place").alias("_least"),
                                               F.count(F.lit(1)).alias("_rows"))
             .join(F.broadcast(carried), "_task"))
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    bounds = settle(parts.select(
        *[F.col(g).alias(f"_in_{g}") for g in group], F.col("_task").alias("_of"), "low", "high",
        "shift", "carried_from", "carried_to",
        F.min(F.col("_least") + F.col("shift")).over(whole).alias("_base"),
        F.sum("_rows").over(whole).alias("_size")), "bounds")
    same = F.col("_task") == F.col("_of")
    for g in group:
        same = same & F.equal_null(F.col(g), F.col(f"_in_{g}"))
    first = F.coalesce(F.when(F.col("_from") == F.col("low"), F.col("carried_from")),
                       F.col("_from") + F.col("shift")) - F.col("_base")
    last = F.coalesce(F.when(F.col("_to") == F.col("high"), F.col("carried_to")),
                      F.col("_to") + F.col("shift")) - F.col("_base")
    size = F.col("_size")
    return runs.join(bounds, same).select(
        *df.columns, (first + 1).alias(f"{prefix}rank"),
        F.when(size > 1, first / F.greatest(size - 1, F.lit(1))).otherwise(0.0)
        .alias(f"{prefix}percent_rank"),
        ((last + 1) / size).alias(f"{prefix}cume_dist"))
