"""Foreign keys checked in a stream where a fact may come before the row it refers to.

A line whose customer is unknown is not an orphan yet: it waits for the customer, as long as event
time allows, and then goes to the valid rows or to quarantine. State holds the lines and arrivals
of the waiting time only; both sides' watermarks close it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradegrain.operators.rules import FAILED


def with_late_matches(facts: DataFrame, arrivals: DataFrame, key: str, fact_time: str,
                      seen_time: str, wait: str, delay: str) -> DataFrame:
    """The facts, and in `matched` whether a row of the key arrived within `wait` before or after.

    A fact with a match leaves at once; one without, when the watermark of both streams has passed
    its time to wait. Copies of an arrival within the watermark count once, so that no fact is
    multiplied. A NULL key never matches.
    """
    left = facts.withWatermark(fact_time, delay).alias("f")
    right = (arrivals.select(F.col(key).alias("_key"), F.col(seen_time).alias("_seen"))
             .withWatermark("_seen", delay).dropDuplicatesWithinWatermark(["_key"]).alias("a"))
    near = (F.col(key) == F.col("_key")) & (
        F.col("_seen") >= F.col(fact_time) - F.expr(f"INTERVAL {wait}")) & (
        F.col("_seen") <= F.col(fact_time) + F.expr(f"INTERVAL {wait}"))
    return (left.join(right, near, "left_outer")
            .select("f.*", F.col("_key").isNotNull().alias("matched")))


def parted(checked: DataFrame, rule: str) -> tuple[DataFrame, DataFrame]:
    """The table that such a stream wrote as its valid rows and its quarantine, which names the
    rule that is broken."""
    return (checked.where("matched").drop("matched"),
            checked.where("not matched").drop("matched")
            .withColumn(FAILED, F.array(F.lit(rule))))
