"""Removal of long passages that an earlier document has as well, by level-wise doubling.

Windows of half the wanted length come first. Only those that stand in two documents are extended
to twice that length, and of these again only the repeated ones matter; at the wanted length the
doubling ends, since a longer repeat is a row of windows of that length.

Of the short windows only anchors are compared: among the short windows inside a long one, the
one with the smallest hash. A long window that stands in two documents has the same anchor in
both, so nothing is lost, and about one short window in thirteen is shuffled. Exact copies of a
text are told by the whole text before: only the copy with the smallest id goes through the
levels, so that a large group of copies weighs as much as one document.

Hashes of windows are 64 bits wide, built from those of half the length; among n candidate
windows about n * n / 2 ** 65 pairs are taken for equal by chance.

Rows: a null text has no words. A null doc_id counts as larger than all others. Rows with the same
doc_id never remove from each other. Documents of fewer words than a window stay whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tradegrain.llm.frames import add_columns, arrow
from tradegrain.llm.words import NON_SPACE, Words, each_piece, mix, same_text
from tradegrain.session import settle

WINDOW = 50  # words
_LAST = (1 << 63) - 1


def window_hashes(one: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` words from each word on, from hashes of half the length."""
    if length == 1:
        return one
    half = window_hashes(one, length // 2)
    step = length // 2
    whole = mix(half[:len(half) - step], half[step:]) if len(half) > step else half[:0]
    if length % 2:
        whole = mix(whole[:-1], one[length - 1:]) if len(whole) else whole
    return whole


def sliding(values: np.ndarray, width: int, least: np.ufunc) -> np.ndarray:
    """np.minimum or np.maximum of each `width` neighbouring values."""
    if len(values) < width:
        return values[:0]
    reach = 1
    while 2 * reach <= width:
        values = least(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return least(values[:len(values) - rest], values[rest:]) if rest else values


class Windows:
    """The long windows of a piece of texts, and the anchor of each."""

    def __init__(self, words: Words, length: int):
        one = words.hashes()
        half = window_hashes(one, length // 2)
        whole = mix(half[:len(half) - length // 2], half[length // 2:]) \
            if len(half) > length // 2 else half[:0]
        if length % 2:
            whole = mix(whole[:-1], one[length - 1:]) if len(whole) else whole
        inside = np.flatnonzero(same_text(words.first, length)[:len(whole)])
        self.start = inside
        self.hash = whole[inside]
        self.anchor = sliding(half, length - length // 2 + 1, np.minimum)[inside]
        self.first = np.searchsorted(inside, words.first)

    def of(self, text: int) -> slice:
        return slice(self.first[text], self.first[text + 1])


def _hash_list(lists: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, lists)])
    flat = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                    pa.array(flat.view(np.int64), pa.int64()))


def _member(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return np.isin(values, wanted.view(np.uint64))


def _anchors(length: int):
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        out = []
        for low, high, words in each_piece(batch.column(0), NON_SPACE, lower=False):
            windows = Windows(words, length)
            out += [np.unique(windows.anchor[windows.of(i)]) for i in range(high - low)]
        return [_hash_list(out)]
    return compute


def _extended(length: int):
    """The long windows whose anchor survived, as rows (id, key, window)."""
    def run(batches):
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("anchors"))
            for low, high, words in each_piece(batch.column("text"), NON_SPACE, lower=False):
                windows, found, row = Windows(words, length), [], []
                for i in range(high - low):
                    alive = lists[low + i].values.to_numpy(zero_copy_only=False)
                    part = windows.of(i)
                    own = np.unique(windows.hash[part][_member(windows.anchor[part], alive)])
                    found.append(own)
                    row.append(np.full(len(own), low + i))
                at = pa.array(np.concatenate(row), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(at), batch.column("key").take(at),
                     pa.array(np.concatenate(found).view(np.int64), pa.int64())],
                    names=["id", "key", "window"])
    return run


def _kept(length: int):
    """Each text without the words of its removed windows."""
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        lists, copies = batch.column(1), batch.column(2)
        total, removed, kept = [], [], []
        for low, high, words in each_piece(batch.column(0), NON_SPACE, lower=False):
            windows = None
            for i in range(high - low):
                n = int(words.first[i + 1] - words.first[i])
                # bytes.split() cuts at the same six characters as the words here.
                own = words.text(i).split()
                covered = np.zeros(n, bool)
                if copies[low + i].as_py():
                    covered[:] = n >= length
                elif lists[low + i].is_valid:
                    windows = windows or Windows(words, length)
                    part = windows.of(i)
                    gone = _member(windows.hash[part],
                                   lists[low + i].values.to_numpy(zero_copy_only=False))
                    edge = np.zeros(n + 1, np.int64)
                    start = windows.start[part][gone] - words.first[i]
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + length, -1)
                    covered = np.cumsum(edge)[:-1] > 0
                total.append(n)
                removed.append(int(covered.sum()))
                kept.append(b" ".join(w for w, c in zip(own, covered.tolist()) if not c).decode())
        return [pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(kept, pa.string())]
    return compute


def repeated(rows: DataFrame, value: str) -> DataFrame:
    """The values that stand in documents with different ids, and the smallest such id."""
    return (rows.groupBy(value).agg(F.min("id").alias("earliest"), F.max("id").alias("latest"))
            .where("earliest < latest").select(value, "earliest"))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and kept_text, its words without those of
    windows that also start in a document with a smaller id, joined by single spaces."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", "text", F.coalesce("doc_id", F.lit(_LAST)).alias("id"),
                         F.unhex(F.md5(F.col("text").cast("binary"))).alias("key"))

    anchors = StructType([StructField("anchors", ArrayType(LongType()))])
    marked = settle(add_columns(texts.select("id", "key", "text"), ["text"], anchors,
                                _anchors(window)).select("id", "key", "anchors"), "anchors")
    first = marked.groupBy("key").agg(F.min("id").alias("original"))
    marked = marked.join(first, "key")
    copies = marked.where("id > original").select("id", "key").distinct()

    short = marked.where("id = original").select("id", "key", F.explode("anchors").alias("anchor"))
    alive = (short.join(repeated(short, "anchor"), "anchor", "left_semi")
             .groupBy("id", "key").agg(F.collect_set("anchor").alias("anchors")))
    rows = StructType([StructField("id", LongType()), texts.schema["key"],
                       StructField("window", LongType())])
    long = settle(arrow(texts.select("id", "key", "text").join(alive, ["id", "key"]),
                        _extended(window), rows), "windows")
    gone = (long.join(repeated(long, "window"), "window").where("id > earliest")
            .groupBy("id", "key").agg(F.collect_set("window").alias("windows")))

    verdicts = (gone.withColumn("copy", F.lit(False))
                .unionByName(copies.withColumn("copy", F.lit(True)), allowMissingColumns=True))
    counted = StructType([StructField("n_words", LongType()), StructField("n_removed", LongType()),
                          StructField("kept_text", StringType())])
    judged = texts.join(verdicts, ["id", "key"], "left").select("doc_id", "text", "windows", "copy")
    return (add_columns(judged, ["text", "windows", "copy"], counted, _kept(window))
            .drop("text", "windows", "copy"))
