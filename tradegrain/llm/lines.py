"""Removal of lines that many documents share, through sharded minimal perfect hash tables.

A line's key is the line without white space at its ends, A-Z lower-cased. Each task counts the
documents of every key by a 128-bit hash; the sums of `least_docs` and more are cut into shards of
about `SHARD_KEYS` keys, and a task makes a shard a minimal perfect hash with three arrays by slot:
the fingerprint (the half of the hash that does not choose the slot), the number of documents, and
the largest doc_id. A key in fewer documents needs no slot, since the fingerprint tells it apart.

Documents probe the arrays; lines are never joined. Tables up to `BROADCAST_BYTES`, about three
million lines, go to the texts, which then are not shuffled. Beyond that the texts' hashes go to
the shards: a partition holds its shards' tables and the hashes that ask for them, sorted so that
a table comes first, and keeps one table at a time. A shard that is asked more often than others,
as by a line of a third of all documents, stands in several copies that share the questions.

Lines are counted by XXH3 of 128 bits. A line without a slot is taken for the one at a slot if
their 64-bit fingerprints agree: by chance once in 2^64 lines. A task holds a batch of texts with
their lines, so a text of any length stays one row.

Rows: each row is a document, so repeated rows count each, and rows that share the largest doc_id
keep their lines. A null or empty text is one empty line. A null doc_id counts as smaller than all
others. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from xxhash import xxh3_128_digest

from tradegrain.llm.frames import add_columns, arrow, ship
from tradegrain.llm.words import mix
from tradegrain.session import settle

LEAST_POINTS, LEAST_DOCS = 20, 3
SHARD_KEYS = 1 << 16
BROADCAST_BYTES = 64 << 20
SLOT_BYTES = 21                  # of a key in a table: fingerprint, count, doc_id, about 4 bits
HOT_SHARDS = 1000                # at most so many shards stand in copies
_FIRST = -(1 << 63)
_SPACE = b" \t\n\v\f\r"

Found = tuple[np.ndarray, np.ndarray, np.ndarray]


def hashed_lines(text: bytes, least: int) -> tuple[list[bytes], list[int], list[bytes]]:
    """A text's lines, which of them have a key of `least` code points or more, and their hashes."""
    lines = text.split(b"\n")
    at, digests = [], []
    for i, line in enumerate(lines):
        key = line.strip(_SPACE).lower()      # bytes.lower() changes A-Z only
        # A code point has at most four bytes.
        if len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least):
            at.append(i)
            digests.append(xxh3_128_digest(key))
    return lines, at, digests


def halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The place (it chooses shard and slot) and the fingerprint of each hash."""
    pairs = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def _texts(column: pa.Array) -> Iterator[bytes]:
    for text in column.cast(pa.large_binary()):
        yield text.as_py() or b""


def _counts(least: int) -> Callable:
    """Rows (place, print, n, last) of a batch: the rows that hold a key, and the largest id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, row = [], []
            for i, text in enumerate(_texts(batch.column(1))):
                own = set(hashed_lines(text, least)[2])
                digests += own
                row += [i] * len(own)
            place, mark = halves(digests)
            order = np.lexsort((mark, place))
            place, mark = place[order], mark[order]
            ids = batch.column(0).to_numpy(zero_copy_only=False)[np.array(row, np.int64)][order]
            new = np.ones(len(place), bool)
            new[1:] = (place[1:] != place[:-1]) | (mark[1:] != mark[:-1])
            starts = np.flatnonzero(new)
            n = np.diff(np.append(starts, len(place)))
            last = np.maximum.reduceat(ids, starts) if len(starts) else ids
            yield pa.RecordBatch.from_arrays(
                [pa.array(place[starts].view(np.int64)), pa.array(mark[starts].view(np.int64)),
                 pa.array(n, pa.int64()), pa.array(last, pa.int64())],
                names=["place", "print", "n", "last"])
    return run


class Table:
    """A minimal perfect hash of distinct 64-bit places, and what stands at its slots.

    Level after level, each key left has one of two bits a key; keys alone on their bit are done,
    and their slot is the number of bits set before theirs. Keys that share all 64 bits of their
    place with another (all but one of them) are kept in a list beside it.
    """

    def __init__(self, levels: list[np.ndarray], columns: dict[str, np.ndarray], spare: int):
        self.levels, self.columns, self.spare = levels, columns, spare
        self.before, base = [], 0
        for bits in levels:
            self.before.append(base + np.cumsum(bits, dtype=np.int32) - bits)
            base += int(bits.sum())
        self.slots = base

    @classmethod
    def of(cls, place: np.ndarray, mark: np.ndarray, n: np.ndarray, last: np.ndarray) -> Table:
        _, once = np.unique(place, return_index=True)
        spare = np.setdiff1d(np.arange(len(place)), once)
        levels, order, left = [], [], once
        while len(left):
            size = max(64, 2 * len(left))
            bit = cls._bit(place[left], len(levels), size)
            alone = np.bincount(bit, minlength=size) == 1
            levels.append(alone)
            done = left[alone[bit]]
            order.append(done[np.argsort(bit[alone[bit]])])
            left = left[~alone[bit]]
        order = np.concatenate([*order, spare]).astype(np.int64)
        columns = {"place": place[spare], "print": mark[order], "last": last[order],
                   "n": np.minimum(n[order], (1 << 32) - 1).astype(np.uint32)}
        return cls(levels, columns, len(spare))

    @staticmethod
    def _bit(place: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(place, np.full(len(place), level + 1, np.uint64))
                % np.uint64(size)).astype(np.int64)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, bits=np.packbits(np.concatenate([np.zeros(0, bool), *self.levels])),
                 sizes=np.array([len(x) for x in self.levels], np.int64), **self.columns)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Table:
        with np.load(io.BytesIO(data)) as read:
            columns = {k: read[k] for k in ("place", "print", "last", "n")}
            ends = np.cumsum(read["sizes"])
            bits = np.unpackbits(read["bits"])[:int(ends[-1]) if len(ends) else 0].astype(bool)
        return cls(np.split(bits, ends[:-1]) if len(ends) else [], columns, len(columns["place"]))

    def find(self, place: np.ndarray, mark: np.ndarray) -> Found:
        """Which hashes are in the table, and for these n and last (0 for others)."""
        slot = np.full(len(place), -1, np.int64)
        left = np.arange(len(place))
        for level, bits in enumerate(self.levels):
            bit = self._bit(place[left], level, len(bits))
            hit = bits[bit]
            slot[left[hit]] = self.before[level][bit[hit]]
            left = left[~hit]
        for i in range(self.spare):
            same = (place == self.columns["place"][i]) \
                & (mark == self.columns["print"][self.slots + i])
            slot[same] = self.slots + i
        known = slot >= 0
        known[known] = self.columns["print"][slot[known]] == mark[known]
        n, last = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        n[known], last[known] = self.columns["n"][slot[known]], self.columns["last"][slot[known]]
        return known, n, last


def _shard(place: np.ndarray, shards: int) -> np.ndarray:
    return np.mod(place.view(np.int64), shards)      # as pmod of the signed place


def _build(rows: pa.Table) -> pa.Table:
    """One shard's table; `load` is how many rows ask for its keys."""
    place, mark, n, last = (rows.column(c).to_numpy() for c in ("place", "print", "n", "last"))
    table = Table.of(place.view(np.uint64), mark.view(np.uint64), n, last)
    return pa.table({"shard": rows.column("shard").slice(0, 1).combine_chunks(),
                     "load": pa.array([int(n.sum())], pa.int64()),
                     "data": pa.array([table.to_bytes()], pa.binary())})


def _verdicts(least: int, find: Callable) -> Callable:
    """n_lines, n_dropped, most_docs and kept_text of each row of (id, text, ...)."""
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = [hashed_lines(text, least) for text in _texts(batch.column(1))]
        sizes = [len(at) for _, at, _ in texts]
        ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes)
        known, n, last = find(batch, sizes, *halves([d for _, _, own in texts for d in own]))
        drop = known & (last != ids)
        columns, low = ([], [], [], []), 0
        for (lines, at, _), size in zip(texts, sizes):
            gone = np.flatnonzero(drop[low:low + size])
            kept = lines
            if len(gone):
                out = {at[i] for i in gone.tolist()}
                kept = [line for i, line in enumerate(lines) if i not in out]
            most = int(n[low:low + size][gone].max()) if len(gone) else 0
            for column, value in zip(columns, (len(lines), len(gone), most,
                                               b"\n".join(kept).decode())):
                column.append(value)
            low += size
        return [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())]
    return compute


def _from_tables(spark, tables: list, shards: int) -> Callable:
    """find() in tables that every executor holds."""
    held = spark.sparkContext.broadcast({row["shard"]: bytes(row["data"]) for row in tables})
    opened: dict[int, Table] = {}

    def find(batch: pa.RecordBatch, sizes: list[int], place: np.ndarray,
             mark: np.ndarray) -> Found:
        known = np.zeros(len(place), bool)
        n, last = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        shard = _shard(place, shards)
        order = np.argsort(shard, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            if len(part) and (number := int(shard[part[0]])) in held.value:
                if number not in opened:
                    opened[number] = Table.from_bytes(held.value[number])
                known[part], n[part], last[part] = opened[number].find(place[part], mark[part])
        return known, n, last

    return find


def _from_answers(batch: pa.RecordBatch, sizes: list[int], place: np.ndarray,
                  mark: np.ndarray) -> Found:
    """find() in the answers that stand beside each row."""
    known = np.zeros(len(place), bool)
    n, last = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    low = 0
    for size, answers in zip(sizes, batch.column(2)):
        told = {(a["place"], a["print"]): a for a in answers.as_py() or ()}
        if told:
            for i in range(low, low + size):
                own = told.get((int(place[i:i + 1].view(np.int64)[0]),
                                int(mark[i:i + 1].view(np.int64)[0])))
                if own:
                    known[i], n[i], last[i] = True, own["n"], own["last"]
        low += size
    return known, n, last


def _questions(least: int, shards: int, copies: dict[int, int]) -> Callable:
    """Rows (shard, copy, place, print, row): each hash of a text once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = np.ones(shards, np.int64)
        for shard, number in copies.items():
            share[shard] = number
        for batch in batches:
            own = [list(set(hashed_lines(text, least)[2])) for text in _texts(batch.column(1))]
            place, mark = halves([d for digests in own for d in digests])
            row = np.repeat(batch.column(0).to_numpy(), [len(digests) for digests in own])
            shard = _shard(place, shards)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), pa.array(row % share[shard]), pa.array(place.view(np.int64)),
                 pa.array(mark.view(np.int64)), pa.array(row)],
                names=["shard", "copy", "place", "print", "row"])
    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition sorted by shard and copy, tables first: what its tables say to questions."""
    shard, table = None, None
    for batch in batches:
        number = batch.column(0).to_numpy()
        for part in np.split(np.arange(len(number)), np.flatnonzero(np.diff(number)) + 1):
            low, high = int(part[0]), int(part[-1]) + 1
            rows = batch.slice(low, high - low)
            if number[low] != shard:
                shard, table = int(number[low]), None
            data = rows.column(5)
            for i in range(len(data) - data.null_count):
                table = Table.from_bytes(data[i].as_py())
            rows = rows.filter(data.is_null())
            if table is not None and len(rows):
                place, mark = (rows.column(c).to_numpy().view(np.uint64) for c in (2, 3))
                known, n, last = table.find(place, mark)
                rows = rows.filter(pa.array(known))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(4), rows.column(2), rows.column(3), pa.array(n[known]),
                     pa.array(last[known])], names=["row", "place", "print", "n", "last"])


def _route(texts: DataFrame, tables: DataFrame, shards: int, least: int) -> DataFrame:
    """`texts` (row, text and others) with what the tables say to each row, as `answers`."""
    load = tables.agg(F.sum("load")).first()[0]
    most = max(1 << 20, load // HOT_SHARDS)
    copies = {r["shard"]: -(-r["load"] // most)
              for r in tables.where(F.col("load") > most).select("shard", "load").collect()}
    number = F.ceil(F.col("load") / F.lit(most)).cast("long")
    stored = tables.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), number - 1))
                           .alias("copy"), "data")
    asked = arrow(texts.select("row", "text"), _questions(least, shards, copies),
                  "shard long, copy long, place long, print long, row long")
    met = (asked.withColumn("data", F.lit(None).cast("binary"))
           .unionByName(stored, allowMissingColumns=True).repartition("shard", "copy")
           .sortWithinPartitions("shard", "copy", F.col("data").isNull()))
    told = arrow(met, _answer, "row long, place long, print long, n long, last long")
    return texts.join(told.groupBy("row").agg(
        F.collect_list(F.struct("place", "print", "n", "last")).alias("answers")), "row", "left")


def remove_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, least_points: int = LEAST_POINTS,
                 shard_keys: int = SHARD_KEYS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of `docs`: doc_id, n_lines (before), n_dropped, most_docs (documents of the
    most common dropped line) and kept_text. Keys of `least_points` code points or more that stand
    in `least_docs` documents lose their lines everywhere but in the largest doc_id with them."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text",
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("id"))
    counted = arrow(texts.select("id", "text"), _counts(least_points),
                    "place long, print long, n long, last long")
    common = settle(counted.groupBy("place", "print").agg(F.sum("n").alias("n"),
                                                          F.max("last").alias("last"))
                    .where(F.col("n") >= least_docs), "lines")
    keys = common.count()
    shards = max(1, -(-keys // shard_keys))
    ship(spark)
    tables = settle(common.withColumn("shard", F.pmod("place", F.lit(shards)).cast("long"))
                    .groupBy("shard").applyInArrow(_build, "shard long, load long, data binary"),
                    "line_tables")

    counts = StructType([*(StructField(c, LongType()) for c in ("n_lines", "n_dropped",
                                                               "most_docs")),
                         StructField("kept_text", StringType())])
    names = ["doc_id", *counts.names]
    if keys * SLOT_BYTES <= broadcast_bytes:
        find = _from_tables(spark, tables.select("shard", "data").collect(), shards)
        return add_columns(texts.select("id", "text", "doc_id"), ["id", "text"], counts,
                           _verdicts(least_points, find)).select(*names)
    numbered = settle(texts.withColumn("row", F.monotonically_increasing_id()), "line_texts")
    met = _route(numbered, tables, shards, least_points)
    return add_columns(met, ["id", "text", "answers"], counts,
                       _verdicts(least_points, _from_answers)).select(*names)
