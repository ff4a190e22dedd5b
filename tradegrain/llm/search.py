"""Ranked lexical search of many items in all documents, by an exact dual-tree search.

A score is a sum over an item's terms of the term's weight times its impact in the document, so
items and documents are vectors without negative parts over the items' terms, and a score is their
product. Two hierarchies hold the largest value of each coordinate: one over the items, one over a
task's documents, `BLOCK` at a time, ordered by the group of items that they answer best and how
well. The product of two nodes' maxima bounds every score below them. Pairs of nodes are taken
apart level by level, a pair whose bound is under the weakest k-th score of its items is dropped
whole, and the leaves left are scored exactly, best bounds first, so that the k-th scores rise
early. Equal bounds stay, since a smaller doc_id may win.

Every 64th document by a hash of its id is searched first. The k-th scores found there are lower
bounds of the true ones; all documents are then searched from them, and a task sends on only what
reaches them, so what is ranked at the end does not grow with the number of tasks. All numbers are
integers below 2^53, which 64-bit floats add and multiply exactly.

The items are read `ITEM_BYTES` of their texts at a time; each block goes through the documents and
is written before the next. Terms are told apart by 64-bit hashes; that some word of a corpus
shares that of another among t terms has the chance of t / 2^64 a word.

Rows: each row of either table is an item or a document, repeated rows too. A null text has no
terms; items without terms, or whose terms no document holds, have no rows. A null doc_id comes
after all others among equal scores. A long text is one row of numbers after the first pass. Other
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tradegrain.llm.frames import arrow
from tradegrain.llm.words import LETTERS, each_piece
from tradegrain.session import settle

TOP = 10
BLOCK, DOC_LEAF, ITEM_LEAF = 4096, 64, 8
ITEM_BYTES = 1 << 20
SEED_SHARE, SEED_ROWS = 64, 10_000   # one in so many documents gives the first bounds
_GROUPS = 16                         # groups of items that documents are ordered by
_LAST = (1 << 63) - 1
_EXACT = 1 << 53


class Items:
    """A block of items: the hashes of their terms, sorted, and each item's counts of terms."""

    def __init__(self, texts: pa.Array):
        hashes, sizes = [], []
        for _, _, words in each_piece(texts, LETTERS, lower=True):
            hashes.append(words.hashes())
            sizes.append(words.lengths())
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        self.terms, at = np.unique(hashes, return_inverse=True)
        self.counts = np.zeros((len(sizes), len(self.terms)))
        np.add.at(self.counts, (np.repeat(np.arange(len(sizes)), sizes), at), 1)


def _split(vectors: np.ndarray, rows: np.ndarray, leaf: int) -> np.ndarray:
    """`rows` in an order in which like vectors are neighbours: halved again and again along the
    line through the two that differ most from the first and from each other."""
    if len(rows) <= leaf:
        return rows
    own = vectors[rows]
    one = own[np.argmax(((own - own[0]) ** 2).sum(1))]
    other = own[np.argmax(((own - one) ** 2).sum(1))]
    order = np.argsort(own @ (other - one), kind="stable")
    half = -(-len(rows) // (2 * leaf)) * leaf
    return np.concatenate([_split(vectors, rows[order[:half]], leaf),
                           _split(vectors, rows[order[half:]], leaf)])


def hierarchy(leaves: np.ndarray) -> list[np.ndarray]:
    """Coordinate maxima of the leaves and of the nodes above, two by two up to one root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(np.maximum.reduceat(levels[-1], np.arange(0, len(levels[-1]), 2)))
    return levels


class ItemTree:
    def __init__(self, vectors: np.ndarray):
        self.order = _split(vectors, np.arange(len(vectors)), ITEM_LEAF)
        self.vectors = vectors[self.order]
        starts = np.arange(0, len(vectors), ITEM_LEAF)
        self.levels = hierarchy(np.maximum.reduceat(self.vectors, starts))
        # Of each leaf, the coordinates that it uses, and its items in these alone.
        self.columns = [np.flatnonzero(row) for row in self.levels[0]]
        self.narrow = [self.vectors[s:s + ITEM_LEAF, c].T for s, c in zip(starts, self.columns)]
        self.groups = next(x for x in self.levels if len(x) <= _GROUPS)


class Best:
    """The k best documents of each item so far, and the score below which none matters."""

    def __init__(self, bounds: np.ndarray, k: int):
        self.bounds, self.k = bounds.copy(), k
        self.scores = [np.zeros(0) for _ in bounds]
        self.ids = [np.zeros(0, np.int64) for _ in bounds]

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores[item], scores])
        ids = np.concatenate([self.ids[item], ids])
        first = np.lexsort((ids, -scores))[:self.k]
        self.scores[item], self.ids[item] = scores[first], ids[first]
        if len(first) == self.k:
            self.bounds[item] = max(self.bounds[item], scores[first[-1]])

    def weakest(self) -> np.ndarray:
        """Of each leaf of the items."""
        return np.minimum.reduceat(self.bounds, np.arange(0, len(self.bounds), ITEM_LEAF))


def node_pairs(docs: list[np.ndarray], items: list[np.ndarray],
               weakest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of leaves (document, item) whose bound reaches the items' weakest k-th score, and the
    bounds. Both hierarchies are taken apart from their roots, the higher one first."""
    floors = [weakest]
    while len(floors[-1]) > 1:
        floors.append(np.minimum.reduceat(floors[-1], np.arange(0, len(floors[-1]), 2)))
    at, level = np.zeros(1, np.int64), len(docs) - 1
    of, height = np.zeros(1, np.int64), len(items) - 1
    while True:
        one, back = np.unique(at, return_inverse=True)
        other, forth = np.unique(of, return_inverse=True)
        bounds = (docs[level][one] @ items[height][other].T)[back, forth]
        alive = (bounds >= floors[height][of]) & (bounds > 0)
        at, of, bounds = at[alive], of[alive], bounds[alive]
        if not len(at) or not (level or height):
            return at, of, bounds
        if level >= height:
            level, at, of = level - 1, np.repeat(2 * at, 2), np.repeat(of, 2)
            at[1::2] += 1
        else:
            height, of, at = height - 1, np.repeat(2 * of, 2), np.repeat(at, 2)
            of[1::2] += 1
        there = (at < len(docs[level])) & (of < len(items[height]))
        at, of = at[there], of[there]


def search_block(tree: ItemTree, best: Best, ids: np.ndarray, first: np.ndarray,
                 terms: np.ndarray, impacts: np.ndarray) -> int:
    """Search documents (their terms are a run from `first` on); returns the leaf pairs scored."""
    doc = np.repeat(np.arange(len(ids)), np.diff(first))
    near = np.zeros((len(ids), len(tree.groups)))
    some = np.flatnonzero(np.diff(first))
    if not len(some):
        return 0
    near[some] = np.add.reduceat(tree.groups.T[terms] * impacts[:, None], first[some])
    group = near.argmax(1)
    order = np.lexsort((-near.max(1), group))
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    # Coordinates in the new order, by leaf.
    by = np.argsort(place[doc], kind="stable")
    row, term, value = place[doc][by], terms[by], impacts[by]
    ids = ids[order]
    starts = np.arange(0, len(ids), DOC_LEAF)
    leaves = np.zeros((len(starts), tree.vectors.shape[1]))
    np.maximum.at(leaves, (row // DOC_LEAF, term), value)
    edge = np.searchsorted(row, np.append(starts, len(ids)))
    at, of, bounds = node_pairs(hierarchy(leaves), tree.levels, best.weakest())
    # Leaf by leaf, the one with the best bound first; within it, the best items first.
    highest = np.zeros(len(starts))
    np.maximum.at(highest, at, bounds)
    scored, last, dense = 0, -1, None
    for i in np.lexsort((-bounds, at, -highest[at])).tolist():
        leaf, items = int(at[i]), slice(int(of[i]) * ITEM_LEAF, (int(of[i]) + 1) * ITEM_LEAF)
        if bounds[i] < best.bounds[items].min():
            continue
        if leaf != last:
            low, high = edge[leaf], edge[leaf + 1]
            dense = np.zeros((min(DOC_LEAF, len(ids) - starts[leaf]), leaves.shape[1]))
            dense[row[low:high] - starts[leaf], term[low:high]] = value[low:high]
            last = leaf
        columns = tree.columns[of[i]]
        scores = dense[:, columns] @ tree.narrow[of[i]]
        good = (scores >= best.bounds[items]) & (scores > 0)
        for j in np.flatnonzero(good.any(0)).tolist():
            best.add(items.start + j, scores[good[:, j], j],
                     ids[starts[leaf]:starts[leaf] + DOC_LEAF][good[:, j]])
        scored += 1
    return scored


def _vectors(terms: np.ndarray) -> Callable:
    """Rows (id, n, terms, tfs): a document's number of terms, and the wanted ones with counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in each_piece(batch.column(1), LETTERS, lower=True):
                hashes = words.hashes()
                at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
                mine = terms[at] == hashes
                text = np.repeat(np.arange(high - low), words.lengths())
                found, tf = np.unique(text[mine] * len(terms) + at[mine], return_counts=True)
                offsets = pa.array(np.searchsorted(found, np.arange(high - low + 1) * len(terms)),
                                   pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(words.lengths(), pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(found % len(terms), pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int32()))],
                    names=["id", "n", "terms", "tfs"])
    return run


def _search(held, n_docs: int, n_terms: int, bounds: np.ndarray, k: int) -> Callable:
    """Each task's best documents (item, id, score), those that reach `bounds`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = ItemTree(held.value)
        best = Best(bounds[tree.order], k)
        for whole in batches:
            for low in range(0, len(whole), BLOCK):
                batch = whole.slice(low, BLOCK)
                ids = batch.column(0).to_numpy()
                lists, tfs = batch.column(2), batch.column(3)
                first = lists.offsets.to_numpy().astype(np.int64)
                terms, tf = lists.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
                m = 25 + (75 * batch.column(1).to_numpy() * n_docs) // n_terms
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(first)))
                search_block(tree, best, ids, first - first[0], terms, impact.astype(np.float64))
        found = [np.concatenate([np.zeros(0, np.int64), *column]) for column in (
            [np.full(len(x), tree.order[i]) for i, x in enumerate(best.ids)], best.ids,
            [x.astype(np.int64) for x in best.scores])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found],
                                         names=["item", "id", "score"])
    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def _search_items(texts: DataFrame, items: pa.Table, k: int) -> DataFrame:
    spark = texts.sparkSession
    block = Items(items.column("text").combine_chunks())
    rows = "item long, id long, score long"
    if not len(block.terms):
        return spark.createDataFrame([], rows + ", rank int")
    docs = settle(arrow(texts, _vectors(block.terms),
                        "id long, n long, terms array<int>, tfs array<int>")
                  .where("n > 0"), "term_vectors")
    n_docs, n_terms = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return spark.createDataFrame([], rows + ", rank int")
    # As many rows as the block has terms.
    held = (docs.select(F.explode("terms").alias("term")).groupBy("term")
            .agg(F.count(F.lit(1)).alias("df")).toArrow())
    df = np.zeros(len(block.terms), np.int64)
    df[held.column("term").to_numpy()] = held.column("df").to_numpy()
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1)))
    vectors = block.counts * weights
    if vectors.sum(1).max() * 1_000_000 >= _EXACT:
        raise ValueError("an item is too long for exact sums")
    shared = spark.sparkContext.broadcast(vectors)

    def best(part: DataFrame, bounds: np.ndarray) -> DataFrame:
        return _ranked(arrow(part, _search(shared, n_docs, n_terms, bounds, k), rows), k)

    bounds = np.zeros(len(vectors))
    seed = (docs.where(F.pmod(F.xxhash64("id"), F.lit(SEED_SHARE)) == 0)
            .repartition(int(n_docs // SEED_SHARE // SEED_ROWS) + 1))
    for item, score in (best(seed, bounds).where(F.col("rank") == k).select("item", "score")
                        .collect()):       # one row an item at most
        bounds[item] = score
    found = settle(best(docs, bounds), "ranked")
    shared.destroy()
    return found


def search(docs: DataFrame, items: DataFrame, k: int = TOP,
           item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the `k` best documents of each item with a score above 0."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"), "text")
    numbered = settle(items.select("item_id", "text",
                                   F.monotonically_increasing_id().alias("row")), "items")
    size = numbered.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // item_bytes))
    results = []
    for i in range(blocks):
        block = numbered.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == i).toArrow()
        at = docs.sparkSession.createDataFrame(
            [(n, row) for n, row in enumerate(block.column("row").to_pylist())],
            StructType([StructField("item", LongType()), StructField("row", LongType())]))
        results.append(_search_items(texts, block, k).join(F.broadcast(at), "item")
                       .select("row", "rank", "id", "score"))
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return (found.join(numbered.select("row", "item_id"), "row")
            .select("item_id", F.col("rank").cast("int").alias("rank"),
                    F.when(F.col("id") < _LAST, F.col("id")).alias("doc_id"), "score"))
