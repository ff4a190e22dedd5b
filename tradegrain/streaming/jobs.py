"""Streaming twins of the pipeline: ingest, de-duplicate, check, aggregate, upsert.

Every job takes a checkpoint folder, which must be on storage that all executors share, and
by default handles what has arrived and stops (`availableNow`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tradegrain.functions import line_revenue, month_of
from tradegrain.operators.changes import as_of, last_changes
from tradegrain.operators.keys import keep_one, missing
from tradegrain.plans.medallion import Entity, counts_of, silver
from tradegrain.plans.serving import EVERY, append_changes, fold, read_history, recent_history
from tradegrain.sources.json_files import CORRUPT, with_lineage

AVAILABLE_NOW = {"availableNow": True}


def bronze_stream(spark: SparkSession, folder: str, schema: StructType,
                  files_per_batch: int | None = None) -> DataFrame:
    """New JSON files of a folder as they are, with the text of malformed lines and lineage."""
    reader = (spark.readStream.option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT)
              .schema(StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_lineage(reader.json(folder))


def table_stream(spark: SparkSession, path: str, schema: StructType,
                 files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a table, be it a folder or one file.

    A stream takes a plain path for a folder only, hence the pattern that matches just it.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream's rows to a Parquet folder, exactly once."""
    return _start(stream.writeStream.format("parquet").outputMode("append")
                  .option("path", path), checkpoint)


def deduplicated(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str,
                 spread: int = 0) -> DataFrame:
    """First row per key within the watermark, which bounds the state.

    With `spread`, copies are first reduced within that many shares of the input tasks, so
    that a key with a large part of the rows does not pass through one task; the price is a
    second, short-lived state. Rows without a whole key are no copies of each other and all
    pass: a mark of their own tells them apart.
    """
    marked = (stream.withWatermark(event_time, delay)
              .withColumn("_apart", F.when(missing(keys), F.uuid())))
    if spread > 1:
        marked = (marked.withColumn("_share", F.spark_partition_id() % spread)
                  .dropDuplicatesWithinWatermark([*keys, "_apart", "_share"]).drop("_share"))
    return marked.dropDuplicatesWithinWatermark([*keys, "_apart"]).drop("_apart")


def silver_stream(stream: DataFrame, entity: Entity, valid_path: str, quarantine_path: str,
                  checkpoint: str, counts_path: str | None = None,
                  every: int = EVERY) -> StreamingQuery:
    """Clean and check each batch, and write its valid and quarantined rows.

    The outputs are folders per batch, replaced if the batch is run again. Copies of a key within
    a batch are reduced to one; `current_rows` does the same across batches. In `counts_path` each
    batch leaves its rows and violations per rule, which were counted as its rows passed by. Every
    `every` batches the valid rows are folded to one per key.
    """
    def one_each(rows: DataFrame) -> DataFrame:
        return keep_one(rows.drop("batch"), [entity.key])

    def write(batch: DataFrame, batch_id: int) -> None:
        parts = silver(batch, entity)
        if counts_path:
            _write_batch(counts_of({entity.name: parts}), counts_path, batch_id)
        _write_batch(parts.table, valid_path, batch_id)
        _write_batch(parts.quarantine, quarantine_path, batch_id)
        _fold(batch.sparkSession, valid_path, batch_id, every, one_each)

    return _start(stream.writeStream.foreachBatch(write), checkpoint)


def current_rows(spark: SparkSession, valid_path: str, entity: Entity,
                 every: int = EVERY) -> DataFrame:
    """The silver table over all batches: one row per key, chosen as in the batch pipeline, from
    the last fold and the batches since."""
    return keep_one(_since_fold(spark, valid_path, None, every).drop("batch"), [entity.key])


def daily_revenue(lines: DataFrame, delay: str) -> DataFrame:
    """Revenue per day, final once the watermark has passed it; later lines are left out.

    Windows are aligned to UTC days and give the watermark something to close. In a session of
    another time zone two midnights may fall into one window (a day of 23 hours), so the day of
    the lines is a key of its own.
    """
    return (lines.withColumn("event_time", F.col("order_date").cast("timestamp"))
            .withColumn("revenue", line_revenue())
            .withWatermark("event_time", delay)
            .groupBy(F.window("event_time", "1 day"), "order_date")
            .agg(F.sum("revenue").alias("revenue"), F.count("order_id").alias("orders"))
            .drop("window"))


def monthly_revenue(lines: DataFrame) -> DataFrame:
    """Revenue per calendar month, kept up to date; a month has no fixed length, so this is
    an update-mode aggregate whose state is one row per month."""
    return (lines.withColumn("revenue", line_revenue())
            .groupBy(month_of(F.col("order_date")).alias("order_month"))
            .agg(F.sum("revenue").alias("revenue"), F.count("order_id").alias("orders")))


def publish_updates(aggregate: DataFrame, path: str, checkpoint: str, key: str | None = None,
                    every: int = EVERY) -> StreamingQuery:
    """Write each batch's changed rows of an aggregate under its batch number. With `key`, every
    `every` batches the last row per key is folded beside them."""
    def write(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, path, batch_id)
        if key is not None:
            _fold(batch.sparkSession, path, batch_id, every, lambda rows: _last(rows, key))

    return _start(aggregate.writeStream.outputMode("update").foreachBatch(write), checkpoint)


def latest_updates(spark: SparkSession, path: str, key: str, every: int | None = None) -> DataFrame:
    """The last published row per key. `every` is that of a job that folds: only the last fold and
    the batches since are then read."""
    return _last(_since_fold(spark, path, None, every) if every else spark.read.parquet(path),
                 key).drop("batch")


def _last(updates: DataFrame, key: str) -> DataFrame:
    values = [c for c in updates.columns if c not in (key, "batch")]
    return (updates.groupBy(key).agg(F.max(F.struct("batch", *values)).alias("_last"))
            .select(key, *[f"_last.{c}" for c in values], "_last.batch"))


def upsert_stream(changes: DataFrame, key: str, order: str, history_path: str,
                  checkpoint: str, every: int = EVERY) -> StreamingQuery:
    """Keep a serving copy current from a stream of rows with `op`.

    A batch is reduced to the last change per key (greatest `order`) and added to the change
    history under its batch number, so a batch costs what it changes and not the whole copy;
    a batch that is run again replaces itself. Every `every` batches the copy is folded anew.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        append_changes(history_path, last_changes(batch, key, order), batch_id)
        fold(batch.sparkSession, history_path, key, batch_id, order, every)

    return _start(changes.writeStream.foreachBatch(write), checkpoint)


def serving_copy(spark: SparkSession, history_path: str, key: str, order: str,
                 version: int | None = None, every: int = EVERY) -> DataFrame:
    """The copy after a batch, by default the last: per key the change of greatest `order`, so
    that a change that arrives late does not undo a newer one."""
    if version is None:
        version = read_history(spark, history_path).agg(F.max("version")).first()[0]
    return as_of(recent_history(spark, history_path, version, every).drop("version"), key, order)


def finish(query: StreamingQuery, seconds: int | None = None) -> None:
    """Wait for a query that stops by itself; raise if it fails, or if the caller set a limit and
    it takes longer."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"streaming query ran longer than {seconds} s")


def _start(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    return (writer.option("checkpointLocation", checkpoint).trigger(**AVAILABLE_NOW).start())


def _write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def _since_fold(spark: SparkSession, path: str, batch_id: int | None, every: int) -> DataFrame:
    """Rows of the last fold before a batch (by default the last one) and of the batches since.
    Batches are numbered from 0 without gaps; all calls on a folder take the same `every`."""
    path = path.rstrip("/")
    if batch_id is None:
        batch_id = spark.read.parquet(path).agg(F.max("batch")).first()[0]
        if batch_id is None:                       # no batch has a row
            return spark.read.parquet(path)
    start = max(0, (batch_id - 1) // every * every)
    since = range(start + 1 if start else 0, batch_id + 1)
    rows = (spark.read.option("basePath", path)
            .parquet(*[f"{path}/batch={b}" for b in since]))
    if not start:
        return rows
    return rows.unionByName(spark.read.parquet(f"{path}.folded/upto={start}"),
                            allowMissingColumns=True)


def _fold(spark: SparkSession, path: str, batch_id: int, every: int,
          one_each: Callable[[DataFrame], DataFrame]) -> None:
    """Every `every` batches, `one_each` of what is known, written beside the batches. A batch that
    is run again replaces its fold."""
    if batch_id and batch_id % every == 0:
        rows = one_each(_since_fold(spark, path, batch_id, every))
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}.folded/upto={batch_id}")
