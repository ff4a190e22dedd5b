"""Benchmark decontamination with suffix arrays of the training texts.

Each task turns its texts, a few megabytes at a time (a shard), into word numbers of the benchmark's
vocabulary and sorts the shard's suffixes into a suffix array by prefix doubling. Every suffix of
every test item is then searched in it by bisection, word by word, which gives its longest
verbatim match and the places of it. Only stretches that could hold a match are sorted: a suffix
ends where two neighbouring words never stand together in the benchmark, and stretches shorter
than the shortest window are left out, since no window fits into them.

The texts stay in place; the benchmark goes to them, in blocks of at most BLOCK_BYTES. A benchmark of
one block takes one pass. A larger one takes a round for each block, so that no more than one is held
at a time: what a block hits is written before the next one is made, and joined in the end.

Rows: a null text has no words and is clean. Items that are null or have no words match nothing.
Items that share an id count as one item; items without an id mark words but count as no item.
Repeated rows and documents without an id are judged one by one like any others.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tradegrain.llm.frames import add_columns, arrow, fresh, quoted, text_bytes
from tradegrain.llm.words import LETTERS, Words, buffers, each_piece, same_text
from tradegrain.session import settle

WINDOW = 13            # words
HIT_SHARE = 20         # contaminated: hit words times this reach all words
BLOCK_BYTES = 16 << 20

FOUND = StructType([
    StructField("n_words", LongType()), StructField("n_hit", LongType()),
    StructField("longest", LongType()),
    StructField("spans", ArrayType(StructType([StructField("start", IntegerType()),
                                               StructField("end", IntegerType())]))),
    StructField("items", ArrayType(StringType()))])


@dataclass
class Tests:
    """A block of the benchmark: items one after the other as word numbers, 0 after each."""

    hashes: np.ndarray      # of the vocabulary, sorted; word number n is at n - 1
    vocabulary: list[bytes]
    words: np.ndarray       # word numbers
    left: np.ndarray        # words from here to the end of the item
    window: np.ndarray      # words of the window that starts here; 0: none does
    item: np.ndarray        # item of each word
    ids: list[str | None]
    pairs: np.ndarray       # neighbouring words, as first * base + second, sorted

    @property
    def shortest(self) -> int:
        return int(self.window[self.window > 0].min(initial=1 << 30))

    @staticmethod
    def of(rows: list[tuple], window: int) -> Tests:
        data, offsets = buffers(pa.array([text for _, text in rows], pa.string()))
        found = Words(data, offsets, LETTERS, lower=True)
        hashes, at, number = np.unique(found.hashes(), return_index=True, return_inverse=True)
        lengths = found.lengths()
        n = len(number) + len(rows)
        words, left = np.zeros(n, np.int64), np.zeros(n, np.int64)
        item = np.repeat(np.arange(len(rows)), lengths + 1)
        place = np.arange(len(number)) + np.repeat(np.arange(len(rows)), lengths)
        words[place] = number + 1
        ends = np.cumsum(lengths + 1) - 1
        left = ends[item] - np.arange(n)
        starts = np.zeros(n, np.int64)
        whole = left >= window
        starts[whole] = window
        short = lengths < window
        first = ends - lengths
        starts[first[short]] = lengths[short]
        base = len(hashes) + 1
        pairs = np.unique((words[:-1] * base + words[1:])[(words[:-1] > 0) & (words[1:] > 0)])
        return Tests(hashes, [found.word(i) for i in at], words, left, starts, item,
                     [None if i is None else str(i) for i, _ in rows], pairs)


def among(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in `sorted_values`, or -1."""
    if not len(sorted_values):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return np.where(sorted_values[at] == values, at, -1)


class Shard:
    """The suffix array of a piece of the training texts, cut to what the tests can match."""

    def __init__(self, numbers: np.ndarray, first: np.ndarray, tests: Tests):
        base = len(tests.hashes) + 1
        n = len(numbers)
        goes_on = np.zeros(n, bool)
        both = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0) & same_text(first, 2)[:-1])
        goes_on[both] = among(tests.pairs, numbers[both] * base + numbers[both + 1]) >= 0
        last = np.flatnonzero(~goes_on)                      # of each stretch
        begin = np.concatenate(([0], last[:-1] + 1)) if len(last) else last
        keep = (last - begin + 1 >= tests.shortest) & (numbers[begin] > 0) if len(last) else []
        begin, length = begin[keep], (last - begin + 1)[keep]
        # Stretches one after the other, a 0 after each.
        total = int(length.sum()) + len(length)
        self.words = np.zeros(total + 1, np.int64)
        self.place = np.full(total + 1, -1, np.int64)        # in the shard
        inner = np.arange(int(length.sum()))
        own = inner + np.repeat(np.arange(len(length)), length)
        self.place[own] = inner + np.repeat(begin - (np.cumsum(length) - length), length)
        self.words[own] = numbers[self.place[own]]
        self.array = self._sorted(int(tests.left.max(initial=1)))

    def _sorted(self, deepest: int) -> np.ndarray:
        real = np.flatnonzero(self.words)
        rank, depth = self.words.copy(), 1
        while depth < deepest and len(real):
            following = np.zeros_like(rank)
            following[:-depth] = rank[depth:] if depth < len(rank) else 0
            key = rank[real] * (int(rank.max()) + 1) + following[real]
            distinct, new = np.unique(key, return_inverse=True)
            rank[real] = new + 1
            if len(distinct) == len(real):
                break
            depth *= 2
        return real[np.argsort(rank[real], kind="stable")]

    def _bound(self, low, high, depth, word, after: bool):
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low + high) // 2
            at = np.minimum(self.array[np.minimum(middle, len(self.array) - 1)] + depth,
                            len(self.words) - 1)
            right = self.words[at] <= word if after else self.words[at] < word
            low = np.where(open_ & right, middle + 1, low)
            high = np.where(open_ & ~right, middle, high)
        return low

    def search(self, tests: Tests) -> tuple[np.ndarray, ...]:
        """For each test suffix: longest match and its range; the range at its window's length."""
        n = len(tests.words)
        longest = np.zeros(n, np.int64)
        low, high = np.zeros(n, np.int64), np.full(n, len(self.array))
        window_low, window_high = np.zeros(n, np.int64), np.zeros(n, np.int64)
        live, depth = np.flatnonzero(tests.left > 0), 0
        while len(live) and len(self.array):
            word = tests.words[live + depth]
            new_low = self._bound(low[live], high[live], depth, word, after=False)
            new_high = self._bound(new_low, high[live], depth, word, after=True)
            some = new_low < new_high
            live, depth = live[some], depth + 1
            low[live], high[live], longest[live] = new_low[some], new_high[some], depth
            done = live[tests.window[live] == depth]
            window_low[done], window_high[done] = low[done], high[done]
            live = live[tests.left[live] > depth]
        return longest, low, high, window_low, window_high


def numbered(words: Words, tests: Tests) -> np.ndarray:
    return among(tests.hashes, words.hashes()) + 1


def checked(words: Words, numbers: np.ndarray, places: np.ndarray, tests: Tests) -> np.ndarray:
    """The places whose word is not the one its hash stands for."""
    return np.array([p for p in places.tolist()
                     if words.word(p) != tests.vocabulary[numbers[p] - 1]], np.int64)


def spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range each is from."""
    size = high - low
    return (np.arange(int(size.sum())) + np.repeat(low - (np.cumsum(size) - size), size),
            np.repeat(np.arange(len(size)), size))


def _piece(words: Words, tests: Tests, hit: np.ndarray, longest: np.ndarray,
           items: list[set]) -> None:
    """Mark in `hit` what the windows cover; note each text's longest match and its items."""
    numbers, first = numbered(words, tests), words.first
    while True:
        shard = Shard(numbers, first, tests)
        length, low, high, window_low, window_high = shard.search(tests)
        found = np.flatnonzero(window_low < window_high)
        if not len(found):
            return
        # Windows with the same words have the same range: each range is walked once.
        ranges, of = np.unique(np.stack([window_low[found], window_high[found],
                                         tests.window[found]]), axis=1, return_inverse=True)
        at, which = spread(ranges[0], ranges[1])
        start, size = shard.place[shard.array[at]], ranges[2][which]
        edge = np.zeros(len(hit) + 1, np.int64)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + size, -1)
        covered = np.cumsum(edge)[:-1] > 0
        wrong = checked(words, numbers, np.flatnonzero(covered), tests)
        if not len(wrong):
            break
        numbers[wrong] = 0
    hit |= covered
    text = np.searchsorted(first, start, "right") - 1
    named = [set() for _ in range(ranges.shape[1])]
    for window, group in zip(found.tolist(), of.ravel().tolist()):
        if (name := tests.ids[tests.item[window]]) is not None:
            named[group].add(name)
    for pair in np.unique(text * len(named) + which).tolist():
        items[pair // len(named)] |= named[pair % len(named)]
    # A text's longest match: the deepest range that one of its suffixes is in.
    far = found[np.argsort(length[found])]
    at, which = spread(low[far], high[far])
    np.maximum.at(longest, np.searchsorted(first, shard.place[shard.array[at]], "right") - 1,
                  length[far][which])


class Blocks:
    """The benchmark in blocks of bounded size; by a hash, so that blocks are alike."""

    def __init__(self, benchmark: DataFrame, window: int, block_bytes: int):
        self.items = (benchmark.select("item_id", F.col("text").alias("text"))
                      .where(F.col("text").isNotNull()))
        self.window = window
        self.count = max(1, math.ceil(2 * text_bytes(self.items) / block_bytes))
        self.context = benchmark.sparkSession.sparkContext

    def broadcast(self, number: int):
        block = F.pmod(F.xxhash64("item_id", "text"), F.lit(self.count))
        rows = [tuple(r) for r in self.items.where(block == number).collect()]
        return self.context.broadcast(Tests.of(rows, self.window))

    def rounds(self, one: Callable[..., DataFrame], label: str) -> DataFrame:
        """The rows of `one`, which takes a block's broadcast, over all blocks; the rows of several
        are written block by block, and each block is let go once its rows are there."""
        if self.count == 1:
            return one(self.broadcast(0))
        written = []
        for number in range(self.count):
            tests = self.broadcast(number)
            written.append(settle(one(tests), label))
            tests.destroy()
        return reduce(DataFrame.unionByName, written)


def _found_in(tests):
    """What one block finds in the texts of a batch."""
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        out = []
        for _, _, words in each_piece(batch.column(0), LETTERS, lower=True):
            first = words.first
            hit = np.zeros(len(words.starts), bool)
            longest, items = np.zeros(len(first) - 1, np.int64), [set() for _ in first[1:]]
            _piece(words, tests.value, hit, longest, items)
            for i in range(len(first) - 1):
                own = hit[first[i]:first[i + 1]]
                turns = np.flatnonzero(np.diff(own, prepend=False, append=False))
                out.append({"n_words": len(own), "n_hit": int(own.sum()),
                            "longest": int(longest[i]), "items": sorted(items[i]),
                            "spans": [{"start": s, "end": e} for s, e in
                                      turns.reshape(-1, 2).tolist()]})
        return [pa.array(out, FOUND_ARROW)]
    return compute


def _together(batch: pa.RecordBatch) -> list[pa.Array]:
    """One finding from those of several blocks: lists of spans and of items, words, and longest."""
    out = []
    for spans, items, words, longest in zip(*[c.to_pylist() for c in batch.columns]):
        merged = []
        for span in sorted((s for part in spans for s in part), key=lambda s: s["start"]):
            if merged and span["start"] <= merged[-1]["end"]:
                merged[-1]["end"] = max(merged[-1]["end"], span["end"])
            else:
                merged.append(dict(span))
        out.append({"n_words": words, "n_hit": sum(s["end"] - s["start"] for s in merged),
                    "longest": longest, "spans": merged,
                    "items": sorted({i for part in items for i in part})})
    return [pa.array(out, FOUND_ARROW)]


def find(docs: DataFrame, benchmark: DataFrame, found: str, window: int = WINDOW,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` with a column `found` of the fields of FOUND: words, hit words, the longest verbatim
    match, the spans of hit words, and the ids of the items found, sorted as text."""
    blocks = Blocks(benchmark, window, block_bytes)
    found_type = StructType([StructField(found, FOUND)])
    if blocks.count == 1:
        return add_columns(docs, ["text"], found_type, _found_in(blocks.broadcast(0)))
    # Rows are numbered in the written table, as several rounds must number them alike.
    row = fresh(docs, "row")
    numbered_docs = settle(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    texts = numbered_docs.select(F.col(row).alias("row"), "text")
    part = StructType([StructField("part", FOUND)])
    parts = blocks.rounds(lambda tests: add_columns(texts, ["text"], part, _found_in(tests))
                          .select("row", "part.*").where("n_hit > 0"), "hits")
    hits = parts.groupBy("row").agg(
        F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"),
        F.max("n_words").alias("n_words"), F.max("longest").alias("longest"))
    hits = add_columns(hits, ["spans", "items", "n_words", "longest"], found_type, _together)
    joined = numbered_docs.join(hits.select(F.col("row").alias(row), *quoted([found])), row, "left")
    # Texts that no block hits: their words only.
    joined = add_columns(joined.withColumnRenamed(found, name := fresh(joined, "known")),
                         ["text", name], found_type, _with_words)
    return joined.select(*quoted([*docs.columns, found]))


def _with_words(batch: pa.RecordBatch) -> list[pa.Array]:
    """The finding of each text, and for a text without one the number of its words."""
    lengths = [n for _, _, words in each_piece(batch.column(0), LETTERS, lower=True)
               for n in words.lengths().tolist()]
    return [pa.array([known or {"n_words": n, "n_hit": 0, "longest": 0, "spans": [], "items": []}
                      for n, known in zip(lengths, batch.column(1).to_pylist())], FOUND_ARROW)]


FOUND_ARROW = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ("items", pa.list_(pa.string()))])


def is_contaminated(found: str, share: int = HIT_SHARE):
    hit, words = F.col(f"{found}.n_hit"), F.col(f"{found}.n_words")
    return (hit > 0) & (share * hit >= words)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: how much of it stands in the benchmark, and in which items."""
    found = find(docs.select("doc_id", "text"), benchmark, "found")
    items = F.col("found.items")
    return found.select(
        "doc_id", "found.n_words", "found.n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        is_contaminated("found").alias("contaminated"),
        F.col("found.longest").alias("longest_match"), "found.spans")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the contaminated ones; all columns as they were."""
    name = fresh(docs, "found")
    return find(docs, benchmark, name).where(~is_contaminated(name)).drop(name)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each test suffix that matches a whole window: its longest verbatim match in the corpus
    (`n_words`) and every place of it (`doc_id`, `word`). Rows of all shards are compared by one
    aggregate per suffix."""
    def step(tests):
        def run(batches):
            for batch in batches:
                block, ids = tests.value, batch.column(0)
                for low, _, words in each_piece(batch.column(1), LETTERS, lower=True):
                    shard = Shard(numbered(words, block), words.first, block)
                    length, lo, hi, window_lo, window_hi = shard.search(block)
                    found = np.flatnonzero(window_lo < window_hi)
                    at, which = spread(lo[found], hi[found])
                    place = shard.place[shard.array[at]]
                    text = np.searchsorted(words.first, place, "right") - 1
                    suffix = found[which]
                    item = block.item[suffix]
                    first = np.searchsorted(block.item, item)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.ids[i] for i in item.tolist()], pa.string()),
                         pa.array(suffix - first, pa.int64()),
                         pa.array(length[suffix], pa.int64()),
                         ids.take(pa.array(text + low, pa.int64())),
                         pa.array(place - words.first[text], pa.int64())],
                        names=["item_id", "item_word", "n_words", "doc_id", "word"])
        return run

    schema = StructType([StructField("item_id", StringType()), StructField("item_word", LongType()),
                         StructField("n_words", LongType()), docs.schema["doc_id"],
                         StructField("word", LongType())])
    narrow = docs.select("doc_id", "text")
    found = Blocks(benchmark, window, block_bytes).rounds(
        lambda tests: arrow(narrow, step(tests), schema), "matches")
    best = found.groupBy("item_id", "item_word").agg(F.max("n_words").alias("n_words"))
    return found.join(best, ["item_id", "item_word", "n_words"], "left_semi")
