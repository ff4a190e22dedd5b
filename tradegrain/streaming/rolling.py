"""Rolling sums per customer as a stream: lines come in, and leave as the watermark passes them.

The state of a customer is one entry for each day with lines in the window, so at most as many as
the window and the delay have days, however many lines there are. Customers are kept together in
shares: a call of the stateful processor and of its state store costs some milliseconds, however few
rows it moves, and so takes the Arrow table of a whole share. An event-time timer of the day that
leaves a share first subtracts what the window has passed, also when no new line of its customers
comes, and then waits for the next.

The query brings what it needs: its functions travel by value, so that no Python worker has to find
this package, and its state is kept by RocksDB whatever the session names for other streams.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, date, datetime, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tradegrain.functions import line_revenue
from tradegrain.streaming.jobs import publish_updates

# Spark starts a Python worker of its own for a stateful processor, on the driver too, which has
# neither the driver's path nor the files sent to the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SHARES = 2048
NO_CUSTOMER = -1                # the share of the lines without a customer
PACKED_ROWS = 500_000           # rows that a task packs together
_EPOCH = date(1970, 1, 1)
_MONEY = pa.decimal128(38, 8)
_SUMS = ("lines", "orders", "revenue")


def leaves_on(day: date, months: int) -> date:
    """The first day on which `day` is out of the window: from then on, `months` months before
    the current day is that day or later."""
    month = day.month - 1 + months
    year, month = day.year + month // 12, month % 12 + 1
    try:
        return date(year, month, day.day)
    except ValueError:          # the month is shorter, and its last day still looks before `day`
        return date(year + month // 12, month % 12 + 1, 1)


def _millis(day: date) -> int:
    return int(datetime(day.year, day.month, day.day, tzinfo=UTC).timestamp() * 1000)


def start_on(day: date, months: int) -> date:
    """The last day that is out of the window on `day`; `leaves_on` seen from the other end."""
    month = day.month - 1 - months
    year, month = day.year + month // 12, month % 12 + 1
    last = (date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)).day
    return date(year, month, min(day.day, last))


class RollingSums(StatefulProcessor):
    """Emits a customer's sums, numbered by `step`, whenever they change; a later step is greater.

    The key is a share of the customers, and its state one value: an Arrow table of the sums by
    customer and day.
    """

    def __init__(self, months: int):
        self.months = months

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.share = handle.getValueState("share", "step long, timer long, held binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        step, timer, held = self._stored()
        added = None
        for part in rows:
            part = _unpacked(part, key[0] == NO_CUSTOMER)
            added = _summed(["customer", "day"], added, part)
        inside = added.filter(pc.greater(added["day"], self._start(timerValues)))
        held = _summed(["customer", "day"], held, inside)
        yield self._kept(step, timer, held, added["customer"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        step, _, held = self._stored()
        inside = pc.greater(held["day"], self._start(timerValues))
        gone = held.filter(pc.invert(inside))
        yield self._kept(step, None, held.filter(inside), gone["customer"])

    def _start(self, timerValues) -> int:
        """The last day that the watermark has put out of the window, as days are numbered."""
        watermark = timerValues.getCurrentWatermarkInMs() // 86_400_000
        return (start_on(_EPOCH + timedelta(days=watermark), self.months) - _EPOCH).days

    def _stored(self) -> tuple:
        step, timer, held = self.share.get() or (0, None, None)
        return step, timer, pa.ipc.open_stream(held).read_all() if held else None

    def _kept(self, step: int, timer: int | None, held: pa.Table,
              changed: pa.ChunkedArray) -> pd.DataFrame:
        """Store a share's days, and return the sums of the `changed` customers; `timer` is the one
        that waits now."""
        packed = None
        if held.num_rows:
            earliest = _EPOCH + timedelta(days=pc.min(held["day"]).as_py())
            first = _millis(leaves_on(earliest, self.months)) - 1
            if timer is None or first < timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(first)
                timer = first
            packed = pa.BufferOutputStream()
            with pa.ipc.new_stream(packed, held.schema) as stream:
                stream.write_table(held)
            packed = packed.getvalue().to_pybytes()
        self.share.update((step + 1, timer, packed))
        changed = pc.unique(changed)
        nothing = pa.table({"customer": changed, **{
            name: pa.repeat(pa.scalar(0, held.schema.field(name).type), len(changed))
            for name in _SUMS}})
        own = held.filter(pc.is_in(held["customer"], changed)).drop_columns(["day"])
        sums = _summed(["customer"], own, nothing)
        return pd.DataFrame({"customer_id": sums["customer"].to_pandas(), "step": step + 1,
                             **{f"r12_{name}": sums[name].to_pandas() for name in _SUMS}})

    def close(self) -> None:
        pass


def _summed(keys: list[str], *parts: pa.Table | None) -> pa.Table:
    """The tables' sums by `keys`; rows without a customer are of one."""
    rows = pa.concat_tables([part for part in parts if part is not None])
    sums = rows.group_by(keys, use_threads=False).aggregate([(name, "sum") for name in _SUMS])
    return pa.table({name: sums[name if name in keys else f"{name}_sum"]
                     .cast(rows.schema.field(name).type) for name in (*keys, *_SUMS)})


def _by_day(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield from _summed(["customer_id", "order_date"],
                               pa.Table.from_batches([batch])).to_batches()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per share and day with all its customers, as the stateful processor's rows pass
    through Python one by one."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= PACKED_ROWS:
            yield from _pack(held)
            held, count = [], 0
    if count:
        yield from _pack(held)


def _pack(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    rows = _summed(["share", "day", "customer_id"], pa.Table.from_batches(batches))
    rows = rows.sort_by([("share", "ascending"), ("day", "ascending")]).combine_chunks()
    share, day, lines, orders = (rows[c].to_numpy() for c in ("share", "day", "lines", "orders"))
    first = np.flatnonzero(np.r_[True, (share[1:] != share[:-1]) | (day[1:] != day[:-1])])
    ends = np.r_[first, len(rows)].astype("<i4")
    # The 128 bits of an amount are two whole numbers.
    amounts = np.frombuffer(rows["revenue"].chunk(0).buffers()[1], "<i8").reshape(-1, 2)
    sums = np.column_stack([lines, orders, amounts[:len(rows)]])
    return pa.table({
        "share": share[first], "day": day[first],
        "customers": pa.ListArray.from_arrays(ends, rows["customer_id"].chunk(0)),
        "sums": pa.Array.from_buffers(pa.binary(), len(first), [
            None, pa.py_buffer(ends * sums[0].nbytes), pa.py_buffer(sums)])}).to_batches()


def _unpacked(rows: pd.DataFrame, no_customer: bool) -> pa.Table:
    """The rows of `_pack` by customer and day."""
    sums = np.frombuffer(b"".join(rows["sums"]), "<i8").reshape(-1, 4)
    amounts = np.ascontiguousarray(sums[:, 2:])
    return pa.table({
        "customer": pa.nulls(len(sums)) if no_customer
        else pa.array(np.concatenate(list(rows["customers"]))),
        "day": pa.array(np.repeat(rows["day"], [len(own) for own in rows["customers"]]),
                        pa.int32()),
        "lines": sums[:, 0], "orders": sums[:, 1],
        "revenue": pa.Array.from_buffers(_MONEY, len(sums), [None, pa.py_buffer(amounts)])})


def rolling_sums(lines: DataFrame, delay: str, months: int = 12,
                 shares: int = SHARES) -> DataFrame:
    """A stream of (customer_id, step, r12_lines, r12_orders, r12_revenue) from a stream of lines:
    the sums of the lines after `months` months before the watermark's day. Lines that come later
    than `delay` allows, or have no date, are left out. The session's time zone must be UTC, as
    days are.

    A batch reads and writes the state of all `shares` that its customers are in. Their number stays
    as it is for the life of a checkpoint."""
    spark = lines.sparkSession
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        raise RuntimeError("rolling sums need the session time zone UTC")
    kind = lines.schema["customer_id"].dataType.simpleString()
    numbers = (lines.where(F.col("order_date").isNotNull())
               .select("customer_id", "order_date", F.lit(1).cast("long").alias("lines"),
                       F.col("order_id").isNotNull().cast("long").alias("orders"),
                       F.coalesce(line_revenue().cast("decimal(38,8)"),
                                  F.lit(0).cast("decimal(38,8)")).alias("revenue")))
    # A customer with a large part of the lines sends one row a day and Arrow batch.
    days = numbers.mapInArrow(_by_day, numbers.schema)
    share = F.pmod(F.xxhash64("customer_id"), F.lit(shares)).cast("int")
    days = (days.select(
        F.when(F.col("customer_id").isNull(), NO_CUSTOMER).otherwise(share).alias("share"),
        # Whole numbers with nulls would pass through pandas as floats.
        F.coalesce("customer_id", F.lit(0).cast(kind)).alias("customer_id"),
        F.unix_date("order_date").alias("day"), *_SUMS).repartition("share"))
    days = (days.mapInArrow(_packed, f"share int, day int, customers array<{kind}>, sums binary")
            .withColumn("event_time", F.date_from_unix_date("day").cast("timestamp"))
            .withWatermark("event_time", delay))
    return days.groupBy("share").transformWithStateInPandas(
        RollingSums(months), f"customer_id {kind}, step long, r12_lines long, r12_orders long,"
                             " r12_revenue decimal(38,8)", "Update", "EventTime")


def publish_rolling(lines: DataFrame, delay: str, path: str, checkpoint: str,
                    months: int = 12) -> StreamingQuery:
    """Write the customers whose sums changed under each batch's number."""
    with _rocksdb(lines.sparkSession):
        return publish_updates(rolling_sums(lines, delay, months), path, checkpoint)


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """The state store that stateful processors need, for a query that starts within; a query
    keeps the settings it started with."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STORE)
        else:
            spark.conf.set(STORE, before)


def current_rolling(updates: DataFrame) -> DataFrame:
    """The last sums of every customer with lines in the window."""
    last = F.max_by(F.struct("r12_lines", "r12_orders", "r12_revenue"), "step")
    return (updates.groupBy("customer_id").agg(last.alias("_last"))
            .where("_last.r12_lines > 0")
            .select("customer_id", "_last.r12_orders", "_last.r12_revenue"))
