"""Difference of two keyed snapshots by digests of key ranges.

Each snapshot is read once into a tree of two levels: a digest for each of up to LEAVES ranges of
the key, and one for each FANOUT ranges beside each other. Trees are compared from the top; rows are
joined only in ranges whose digests differ, and these ranges reach the scan as a filter. The tree of
a snapshot can be kept, so that the next difference reads of it only what changed.

A digest is the number of rows and two 64-bit hashes of whole rows, each combined by XOR, so the
order of rows does not matter. Keys are unique and not NULL. Two ranges of different rows pass for
equal with a chance of about 2^-128.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, IntegralType, StringType

from tradegrain.operators.changes import diff
from tradegrain.session import settle

LEAVES = 4096     # ranges, at most
FANOUT = 64       # ranges under one node of the upper level
PER_LEAF = 4      # keys that are looked at to place a cut
SPANS = 32        # spans of keys that reach the scan as a filter


class Tree(NamedTuple):
    """Digests of a snapshot: (leaf, node, rows, first, second), and the keys at which the leaves
    after the first begin."""
    cuts: list[Any]
    leaves: DataFrame


def key_cuts(df: DataFrame, key: str, leaves: int = LEAVES) -> list[Any]:
    """Ascending keys that part the rows into ranges of about equal size. The keys of least hash are
    looked at, PER_LEAF for a range; where the cuts fall changes no result."""
    kind = df.schema[key].dataType
    if not isinstance(kind, (IntegralType, StringType, DateType, DecimalType)):
        raise ValueError(f"no ranges of keys of type {kind.simpleString()}")
    seen = df.select(key).orderBy(F.xxhash64(key)).limit(leaves * PER_LEAF)
    return [r[0] for r in seen.orderBy(key).collect()][PER_LEAF::PER_LEAF]


def digest_tree(df: DataFrame, key: str, cuts: Sequence[Any], columns: Sequence[str]) -> Tree:
    """The tree of `df` over the given columns, written once. Columns that `df` lacks are NULL."""
    held = [F.col(c) if c in df.columns else F.lit(None) for c in columns]
    # The hash passes over NULL, so which columns are NULL is hashed as well.
    row = [F.concat(F.lit(""), *[F.when(c.isNull(), "0").otherwise("1") for c in held]), *held]
    leaf = _leaf(key, cuts, df.schema[key].dataType)
    hashed = df.select(leaf.alias("leaf"), F.xxhash64(key, *row).alias("first"),
                       F.xxhash64(F.lit(1), key, *row).alias("second"))
    leaves = hashed.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("first").alias("first"),
        F.bit_xor("second").alias("second"))
    return Tree(list(cuts), settle(leaves.withColumn("node", F.floor(F.col("leaf") / FANOUT)),
                                   "digests"))


def changed_leaves(old: Tree, new: Tree) -> list[int]:
    """Leaves whose digests differ, looked for only under nodes that differ."""
    if old.cuts != new.cuts:
        raise ValueError("the trees have different ranges")

    def nodes(tree):
        return tree.leaves.groupBy("node").agg(
            F.sum("rows").alias("rows"), F.bit_xor("first").alias("first"),
            F.bit_xor("second").alias("second"))

    def differing(left, right, on):
        # A range that one side lacks differs as well.
        digests = F.struct("rows", "first", "second")
        both = (left.select(on, digests.alias("left"))
                .join(right.select(on, digests.alias("right")), on, "full"))
        return both.where(~F.equal_null("left", "right")).select(on)

    apart = F.broadcast(differing(nodes(old), nodes(new), "node"))
    found = differing(*[t.leaves.join(apart, "node", "left_semi") for t in (old, new)], "leaf")
    return sorted(r[0] for r in found.collect())


def diff_by_digests(old: DataFrame, new: DataFrame, key: str, ignore: Collection[str] = (),
                    old_tree: Tree | None = None, leaves: int = LEAVES) -> DataFrame:
    """The rows of `changes.diff(old, new, key, ignore)`; ranges of keys with equal digests are
    neither shuffled nor joined, and where files are sorted by key, not read again.

    `old_tree` is a kept tree of `old` over the compared columns.
    """
    columns = [c for c in new.columns if c != key and c not in ignore]
    if old_tree is None:
        old_tree = digest_tree(old, key, key_cuts(old, key, leaves), columns)
    cuts = old_tree.cuts
    changed = changed_leaves(old_tree, digest_tree(new, key, cuts, columns))
    return diff(*[_within(side, key, cuts, changed) for side in (old, new)], key, ignore)


def _literals(cuts: Sequence[Any], kind: DataType) -> Column:
    """An array of thousands of constants as one text, since each column object is a call to the
    JVM; text goes as hexadecimal digits, so that no sign of it needs a quote."""
    texts = (f"CAST(X'{str(c).encode().hex()}' AS STRING)" for c in cuts)
    return F.expr(f"array({', '.join(texts)})").cast(f"array<{kind.simpleString()}>")


def _leaf(key: str, cuts: Sequence[Any], kind: DataType) -> Column:
    """How many cuts are at or below the key, by bisection."""
    steps = [1 << bit for bit in reversed(range(len(cuts).bit_length()))]
    if not steps:
        return F.lit(0)
    array = _literals(cuts, kind)
    return F.reduce(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda found, step: F.when((found + step <= len(cuts))
                                   & (F.get(array, found + step - 1) <= F.col(key)),
                                   found + step).otherwise(found))


def _spans(changed: Sequence[int]) -> list[tuple[int, int]]:
    """First and last leaf of at most SPANS spans that cover the leaves, across the least gaps."""
    gaps = sorted(zip(changed, changed[1:]), key=lambda g: g[1] - g[0], reverse=True)
    apart = sorted(g for g in gaps[:SPANS - 1] if g[1] - g[0] > 1)
    return list(zip([changed[0], *[g[1] for g in apart]], [*[g[0] for g in apart], changed[-1]]))


def _within(df: DataFrame, key: str, cuts: Sequence[Any], changed: Sequence[int]) -> DataFrame:
    """Rows of the given leaves; the spans of keys that hold them are a filter of the scan."""
    if not changed:
        return df.limit(0)
    kind, wanted = df.schema[key].dataType, set(changed)
    spans = F.lit(False)
    for low, high in _spans(changed):
        span = F.lit(True)
        if low > 0:
            span = span & (F.col(key) >= F.lit(cuts[low - 1]).cast(kind))
        if high < len(cuts):
            span = span & (F.col(key) < F.lit(cuts[high]).cast(kind))
        spans = spans | span
    held = "".join("1" if leaf in wanted else "0" for leaf in range(len(cuts) + 1))
    place = _leaf(key, cuts, kind) + 1
    return df.where(spans).where(F.substring(F.lit(held), place, F.lit(1)) == "1")
