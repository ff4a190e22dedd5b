"""Changes between keyed snapshots: difference, application, and reading a change history."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradegrain.operators.keys import reduce_repeats

OP = "op"


def diff(old: DataFrame, new: DataFrame, key: str, ignore: Collection[str] = (),
         unchanged: bool = False) -> DataFrame:
    """INSERT, UPDATE and DELETE rows that lead from `old` to `new`, with `new`'s columns.

    A deleted key carries NULLs. Columns in `ignore` (build stamps) do not make an update.
    With `unchanged`, equal rows are listed too, as SAME. A column that only `new` has was NULL
    before.
    """
    values = [c for c in new.columns if c != key]
    old = old.select("*", *[F.lit(None).cast(new.schema[c].dataType).alias(c)
                            for c in values if c not in old.columns])
    compared = [c for c in values if c not in ignore]
    before = old.select(F.col(key).alias("_old_key"), F.struct(*compared).alias("_before"))
    after = new.select(F.col(key).alias("_new_key"), F.struct(*compared).alias("_after"),
                       *[F.col(c) for c in values])
    joined = before.join(after, F.col("_old_key") == F.col("_new_key"), "full")
    op = (F.when(F.col("_old_key").isNull(), "INSERT")
          .when(F.col("_new_key").isNull(), "DELETE")
          .when(F.equal_null("_before", "_after"), "SAME")
          .otherwise("UPDATE"))
    found = joined.select(F.coalesce("_old_key", "_new_key").alias(key), *values, op.alias(OP))
    return found if unchanged else found.filter(F.col(OP) != "SAME")


def apply_changes(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Replace or add the changed keys and remove the deleted ones."""
    effective = changes.filter(F.col(OP) != "SAME")
    kept = base.join(effective.select(key), key, "left_anti")
    arrived = effective.filter(F.col(OP) != "DELETE").select(*base.columns)
    return kept.unionByName(arrived)


def as_of(history: DataFrame, key: str, version: str, at=None) -> DataFrame:
    """The state at a version: each key's latest change up to it, deleted keys left out.

    `history` holds changes with `op` and an ascending `version`, unique per key.
    """
    known = history if at is None else history.filter(F.col(version) <= at)
    return latest(known, key, version).filter(F.col(OP) != "DELETE").drop(OP)


def latest(history: DataFrame, key: str, version: str) -> DataFrame:
    """Each key's change of the greatest version, deletions among them; keys that changed once
    stay in place."""
    return reduce_repeats(history, [key], lambda rows: last_changes(rows, key, version))


def last_changes(rows: DataFrame, key: str, version: str) -> DataFrame:
    """`latest` by one aggregate, for rows in which most keys repeat or that are few."""
    values = [c for c in rows.columns if c not in (key, version)]
    return (rows.groupBy(key).agg(F.max(F.struct(version, *values)).alias("_latest"))
            .select(key, "_latest.*"))
