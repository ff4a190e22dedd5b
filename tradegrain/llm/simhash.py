"""SimHash fingerprints and near-duplicate groups by a binary-trie self-join.

Distinct fingerprints that differ in at most three bits agree on one of four blocks of 16 bits, so
each is sent to four groups, one for the value of each block. Within its groups a task walks a
binary trie against itself: pairs of nodes go down together bit by bit, add up the bits in which
they differ, and are dropped once these are more than allowed. A group with more fingerprints than
GROUP_ROWS is split again by the same rule over the bits that are still free, until it is small
or no bits are left. A task hands on only as many links as join what its links join, and the
components of all links are found by distributed contraction.

Equal fingerprints are one node, so copies cost nothing.

Rows: null and empty texts have no words and the fingerprint zero, and are linked like any others. A
document without an id gets a component but never names one, unless all its members have none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tradegrain.llm.components import components, forest
from tradegrain.llm.frames import add_columns, arrow, fresh, quoted
from tradegrain.llm.words import NON_SPACE, each_piece, mix
from tradegrain.session import settle

SHINGLE = 3          # words
SEED = 42
BITS = 3             # linked: this many differing bits or fewer
GROUP_ROWS = 20_000  # larger groups are split by further bits
_TASK_ROWS = 1 << 18  # rows of whole groups that a task walks at once
_FRONT = 1 << 19     # node pairs that are expanded at once
_LEAF = 4            # nodes with this many fingerprints between them are compared outright


def _fingerprints(batch: pa.RecordBatch) -> list[pa.Array]:
    out = []
    digest = xxhash.xxh64_intdigest
    for low, high, words in each_piece(batch.column(0), NON_SPACE, lower=True):
        for i in range(high - low):
            own = words.text(i).split()
            if not own:
                out.append(0)
                continue
            joined = b" ".join(own)
            size = np.fromiter(map(len, own), np.int64, len(own)) + 1
            end = np.cumsum(size) - 1
            width = min(SHINGLE, len(own))
            start = (end - size + 1)[:len(own) - width + 1].tolist()
            hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in
                                  zip(start, end[width - 1:].tolist())), np.uint64, len(start))
            counts = np.zeros(64, np.int64)
            for at in range(0, len(hashes), 1 << 15):
                part = hashes[at:at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
                counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
            bits = np.packbits(2 * counts > len(hashes), bitorder="little")
            out.append(int(bits.view("<u8")[0]))
    return [pa.array(np.array(out, np.uint64).view(np.int64), pa.int64())]


def add_fingerprint(docs: DataFrame, name: str) -> DataFrame:
    """`docs` with the fingerprint of each text as a (signed) long."""
    return add_columns(docs, ["text"], StructType([StructField(name, LongType())]), _fingerprints)


def _mask(path: int) -> int:
    """The bits that a group's fingerprints agree on. A path starts at 1; each step adds one of
    four blocks of the bits that are still free."""
    free = list(range(63, -1, -1))
    for step in [int(d) for d in np.base_repr(path, 4)[1:]]:
        quarter = -(-len(free) // 4)
        free = [b for i, b in enumerate(free) if i // quarter != step]
    return sum(1 << b for b in range(64) if b not in free)


def _regroup(batches):
    """Each (fp, path) goes to four groups one step further."""
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        path = batch.column(1).to_numpy(zero_copy_only=False)
        found = [[], [], []]
        for p in np.unique(path).tolist():
            own = fp[path == p]
            for step in range(4):
                child = 4 * p + step
                shared = own & np.uint64(_mask(child))
                for column, values in zip(found, (own, np.full(len(own), child), mix(
                        shared, np.full(len(own), child, np.uint64)))):
                    column.append(values)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c).astype(np.uint64).view(np.int64), pa.int64())
             for c in found] if len(fp) else [pa.array([], pa.int64())] * 3,
            names=["fp", "path", "bucket"])


def trie_pairs(group: np.ndarray, fp: np.ndarray, budget: int):
    """Yields arrays (a, b): places of distinct values in one group with few differing bits.

    `group` and `fp` are sorted by group, then value, so that a trie node is a range of places.
    """
    n = len(fp)
    bounds = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    low, high = bounds[:-1], bounds[1:]
    many = high - low > 1
    zeros = {}
    root = (low[many], high[many])
    stack = [(0, *root, *root, np.zeros(int(many.sum()), np.int64))]
    while stack:
        depth, al, ah, bl, bh, spent = stack.pop()
        if len(al) > _FRONT:
            half = len(al) // 2
            stack += [(depth, *(x[:half] for x in (al, ah, bl, bh, spent))),
                      (depth, *(x[half:] for x in (al, ah, bl, bh, spent)))]
            continue
        small = (ah - al) + (bh - bl) <= _LEAF
        if depth == 64:
            small[:] = True
        if small.any():
            na, nb = (ah - al)[small], (bh - bl)[small]
            each = na * nb
            which = np.repeat(np.arange(len(each)), each)
            k = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
            a, b = al[small][which] + k // nb[which], bl[small][which] + k % nb[which]
            ok = (a < b) & (np.bitwise_count(fp[a] ^ fp[b]) <= budget)
            if ok.any():
                yield a[ok], b[ok]
            al, ah, bl, bh, spent = (x[~small] for x in (al, ah, bl, bh, spent))
        if not len(al):
            continue
        if depth not in zeros:
            bit = (fp >> np.uint64(63 - depth)) & np.uint64(1)
            zeros[depth] = np.concatenate(([0], np.cumsum(bit == 0)))
        count = zeros[depth]
        am, bm = al + count[ah] - count[al], bl + count[bh] - count[bl]
        same = al == bl
        parts = [(al, am, bl, bm, spent), (am, ah, bm, bh, spent), (al, am, bm, bh, spent + 1),
                 *([(x[~same] for x in (am, ah, bl, bm, spent + 1))] if not same.all() else [])]
        new = [np.concatenate(x) for x in zip(*(tuple(p) for p in parts))]
        alive = (new[0] < new[1]) & (new[2] < new[3]) & (new[4] <= budget)
        alive &= ~((new[0] == new[2]) & (new[1] - new[0] == 1))
        stack.append((depth + 1, *(x[alive] for x in new)))


def whole_groups(batches, least: int):
    """The rows (group, fp) of batches that are sorted by group, in runs of whole groups that hold
    about `least` rows or one group."""
    held, size = [], 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(zero_copy_only=False),
                     batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
        size += batch.num_rows
        if size >= least:
            group, fp = (np.concatenate(c) for c in zip(*held))
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield group[:cut], fp[:cut]
            held, size = [(group[cut:], fp[cut:])], size - cut
    if size:
        yield tuple(np.concatenate(c) for c in zip(*held))


def _links(budget: int):
    def run(batches):
        for group, fp in whole_groups(batches, _TASK_ROWS):
            order = np.lexsort((fp, group))
            group, fp = group[order], fp[order]
            signed = fp.view(np.int64)
            kept = forest(pair for a, b in trie_pairs(group, fp, budget)
                          for pair in zip(signed[a].tolist(), signed[b].tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in kept], pa.int64()),
                 pa.array([b for _, b in kept], pa.int64())], names=["a", "b"])
    return run


def links(prints: DataFrame, bits: int = BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Of the distinct fingerprints `fp`: pairs (a, b) with at most `bits` (3 or fewer) differing
    bits, as many as connect all that are linked."""
    rows = "fp long, path long, bucket long"
    open_ = settle(prints.select("fp").distinct(), "prints").withColumn("path", F.lit(1).cast("long"))
    ready = None
    for level in range(6):
        grouped = arrow(open_, _regroup, rows)
        large = grouped.groupBy("bucket").count().where(F.col("count") > group_rows).select("bucket")
        large = settle(large, "large")
        more = level < 5 and not large.isEmpty()
        part = grouped.join(large, "bucket", "left_anti") if more else grouped
        ready = part if ready is None else ready.unionByName(part)
        if not more:
            break
        open_ = settle(grouped.join(large, "bucket", "left_semi").select("fp", "path"), "split")
    # Sorted, so that a task holds some groups at a time, however many it gets.
    groups = ready.select("bucket", "fp").repartition("bucket").sortWithinPartitions("bucket")
    return arrow(groups, _links(bits), "a long, b long")


def grouped_prints(prints: DataFrame) -> DataFrame:
    """(fp, root): a representative fingerprint of each one's component."""
    found = components(links(prints))
    return (prints.select("fp").distinct().join(found, F.col("fp") == F.col("node"), "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, its fingerprint, and the smallest doc_id of its component."""
    prints = settle(add_fingerprint(docs.select("doc_id", "text"), "fp").select("doc_id", "fp"),
                    "fingerprints")
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = settle(grouped_prints(prints).join(first, "fp"), "roots")
    named = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = roots.join(named, "root").select("fp", "component_id")
    return (prints.join(named, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    "component_id"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each component, that of the smallest id (null: largest); of several
    such rows one. All columns as they were."""
    fp, row = fresh(docs, "fp"), fresh(docs, "row")
    marked = settle(add_fingerprint(docs, fp).withColumn(row, F.monotonically_increasing_id()),
                    "marked")
    prints = marked.select(F.col(fp).alias("fp"), "doc_id", F.col(row).alias("row"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = prints.groupBy("fp").agg(F.min(order).alias("first"))
    kept = (grouped_prints(prints).join(first, "fp").groupBy("root")
            .agg(F.min("first").alias("first")).select(F.col("first.row").alias(row)))
    return marked.join(kept, row, "left_semi").select(*quoted(docs.columns))
