"""The keyed serving copy: snapshots laid out for point lookup, and a history of changes.

A history is a folder of change sets by version, counted from 0 without gaps. Every `every` versions
the state is folded into a base beside it, so that a state is read from one base and less than
`every` versions since, however long the history. All calls on a history take the same `every`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradegrain.operators.changes import as_of, diff, latest
from tradegrain.operators.keys import require_unique
from tradegrain.session import BROADCAST_ROWS, settle

EVERY = 16     # versions from one base to the next


def publish(df: DataFrame, path: str, key: str) -> DataFrame:
    """Write a snapshot sorted by its key, so that a lookup reads few row groups.

    The path must be a new one: a snapshot that others read is not overwritten under them.
    """
    rows = settle(df, "snapshot")
    require_unique(rows, key)
    rows.repartitionByRange(key).sortWithinPartitions(key).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(snapshot: DataFrame, key: str, values: Iterable) -> DataFrame:
    """Rows of a few keys; the filter reaches the file scan."""
    return snapshot.filter(F.col(key).isin(list(values)))


def lookup_many(snapshot: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of many keys, given as a table.

    The least and the greatest key reach the file scan as a filter. Up to BROADCAST_ROWS keys go
    to the snapshot, which stays where it is; only beyond that are both sides shuffled.
    """
    keys = settle(wanted.select(key).filter(F.col(key).isNotNull()).distinct(), "wanted")
    rows, least, greatest = keys.agg(F.count(key), F.min(key), F.max(key)).first()
    within = snapshot.filter(F.col(key).between(F.lit(least), F.lit(greatest)))
    return within.join(F.broadcast(keys) if rows <= BROADCAST_ROWS else keys, key, "left_semi")


def publish_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Write a snapshot as a catalogued table in buckets of its key, sorted within them, for joins
    with any number of keys. Choose `buckets` so that a bucket fits a task."""
    rows = settle(df, "snapshot")
    require_unique(rows, key)
    # One task writes a bucket, so that there is one file of each.
    (rows.repartition(buckets, key).write.format("parquet")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def lookup_bucketed(snapshot: DataFrame, key: str, wanted: DataFrame, buckets: int) -> DataFrame:
    """Rows of any number of keys from a table of `publish_bucketed`: the keys, made distinct, are
    brought to the snapshot's buckets, and the snapshot is read where it lies, without a shuffle."""
    keys = (wanted.select(F.col(key).cast(snapshot.schema[key].dataType))
            .filter(F.col(key).isNotNull()).repartition(buckets, key).distinct())
    return snapshot.join(keys.hint("merge"), key, "left_semi")


def append_changes(history_path: str, changes: DataFrame, version: int) -> None:
    """Add a change set under its version; writing the same version again replaces it."""
    changes.write.mode("overwrite").parquet(f"{history_path}/version={version}")


def read_history(spark: SparkSession, history_path: str) -> DataFrame:
    """All versions; a column that came later is NULL in the versions before."""
    return spark.read.option("mergeSchema", "true").parquet(history_path)


def _base(history_path: str, version: int) -> str:
    return f"{history_path.rstrip('/')}.base/upto={version}"


def recent_history(spark: SparkSession, history_path: str, version: int,
                   every: int = EVERY) -> DataFrame:
    """What the state at a version follows from: the last base before it, and the changes since."""
    start = max(0, (version - 1) // every * every)
    first = start + 1 if start else 0
    changes = (spark.read.option("mergeSchema", "true").option("basePath", history_path)
               .parquet(*[f"{history_path}/version={v}" for v in range(first, version + 1)]))
    if not start:
        return changes
    return changes.unionByName(spark.read.parquet(_base(history_path, start)),
                               allowMissingColumns=True)


def fold(spark: SparkSession, history_path: str, key: str, version: int, order: str = "version",
         every: int = EVERY) -> None:
    """Write the base of a version, if one is due: each key's last change by `order`. Deletions
    stay in it, as a change that arrives late may be older than they are."""
    if version and version % every == 0:
        known = recent_history(spark, history_path, version, every)
        latest(known, key, order).write.mode("overwrite").parquet(_base(history_path, version))


def sync(snapshot: DataFrame, history_path: str, key: str, version: int,
         ignore: Iterable[str] = (), every: int = EVERY) -> None:
    """Bring the history up to a rebuilt table: only what changed is written."""
    spark = snapshot.sparkSession
    require_unique(snapshot, key)
    if version == 0:
        changes = snapshot.withColumn("op", F.lit("INSERT"))
    else:
        current = restore(spark, history_path, key, version - 1, every)
        changes = diff(current, snapshot, key, tuple(ignore))
    append_changes(history_path, changes, version)
    fold(spark, history_path, key, version, every=every)


def restore(spark: SparkSession, history_path: str, key: str, version: int,
            every: int = EVERY) -> DataFrame:
    """The table as it stood at a version."""
    known = recent_history(spark, history_path, version, every)
    return as_of(known, key, "version").drop("version")
