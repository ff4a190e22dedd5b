"""Near-duplicate vectors by PCA-ordered tiled comparison; exact.

Vectors are scaled to length one and turned onto principal axes, so that the leading dimensions
hold most of every product. They are ordered by the first axis and cut there into tiles; two tiles
whose ranges lie further apart than two similar vectors can are never brought together. A task
compares two tiles: products are accumulated over the leading dimensions, what the rest can add is
bounded by the product of the suffix norms, and pairs that cannot reach the threshold any more
stop there. What is left is decided by the whole vectors in double precision.

The axes are fitted on a bounded sample (SAMPLE vectors with the smallest hashes); they only decide
how early a comparison stops, not what is found. Equal vectors are one row with a count. A tile
pair gives back one number per vector and as many links as connect what it linked, not its pairs.

The number of tile pairs grows with the square of the rows as far as the first axis cannot part
them; this is the cost of the method for vectors without structure.

Rows: vectors that are null, empty, zero or hold null or non-finite components link with nothing
and form a component of their own. Vectors of different lengths never link. Rows that share a
vec_id are separate vectors. A null vec_id is linked like any other, but names a component only if
no member has an id; such a row is not `kept`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradegrain.llm.components import components, forest
from tradegrain.llm.frames import arrow, ship
from tradegrain.session import settle

COSINE = 0.95
SAMPLE = 10_000       # vectors that the axes are fitted on
TILE_ROWS = 4096
STEPS = (16, 32)      # leading dimensions after which pairs may stop
_BLOCK = 1024         # rows of a tile that are multiplied at once
_SLACK = 1e-4         # for the single precision of the bounds
_PAIRS = 1 << 16      # pairs that are compared in full at once


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows, scaled to length one, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
    x /= np.abs(x).max(axis=1, initial=0, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def axes(nodes: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Principal axes as columns, the strongest first, of a sample by hash."""
    table = nodes.orderBy(F.xxhash64("embedding")).limit(sample).select("embedding").toArrow()
    x = matrix(table["embedding"])
    return np.linalg.eigh(x.T @ x)[1][:, ::-1]


def _jitter(node: np.ndarray) -> np.ndarray:
    """Tells vectors with the same first coordinate apart, so that they can be cut into tiles."""
    return (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) * 2.0 ** -54


def _first_axis(axis: np.ndarray):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column(0).to_numpy()
            place = matrix(batch.column(2)) @ axis + _jitter(node)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.float64())],
                                             names=["node", "copies", "embedding", "place"])
    return run


def _deal(cuts: np.ndarray, cosine: float):
    """Each vector to every pair of tiles, its own and one in reach."""
    reach = np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-6
    tiles = len(cuts) + 1

    def run(batches):
        for batch in batches:
            place = batch.column(3).to_numpy()
            own = np.searchsorted(cuts, place, "right")
            # All vectors of a tile must meet, so reach is counted from the tile's edges.
            low = np.searchsorted(cuts, np.concatenate(([-np.inf], cuts))[own] - reach, "right")
            high = np.searchsorted(cuts, np.concatenate((cuts, [np.inf]))[own] + reach, "right")
            for row in np.array_split(np.arange(len(own)), max(1, len(own) // 1024)):
                n = high[row] - low[row] + 1
                at = np.repeat(row, n)
                other = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - low[row], n)
                pair = np.minimum(own[at], other) * tiles + np.maximum(own[at], other)
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair, pa.int64()), pa.array(own[at], pa.int64()),
                     *(batch.column(i).take(take) for i in range(3))],
                    names=["pair", "tile", "node", "copies", "embedding"])
    return run


def similar(a: np.ndarray, b: np.ndarray, turn: np.ndarray, cosine: float, same: bool):
    """Yields (rows of a, rows of b) with at least that cosine; if `same`, a before b only."""
    ta, tb = (x @ turn for x in (a, b))
    steps = [min(s, a.shape[1]) for s in STEPS]
    rest = [[np.linalg.norm(t[:, s:], axis=1).astype(np.float32) for s in steps] for t in (ta, tb)]
    fa, fb = ta.astype(np.float32), tb.astype(np.float32)
    least = np.float32(cosine - _SLACK)
    for top in range(0, len(a), _BLOCK):
        rows = slice(top, top + _BLOCK)
        bound = fa[rows, :steps[0]] @ fb[:, :steps[0]].T
        bound += rest[0][0][rows, None] * rest[1][0]
        i, j = np.nonzero(bound >= least)
        i += top
        if same:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), _PAIRS):
            r, c = i[at:at + _PAIRS], j[at:at + _PAIRS]
            part = np.einsum("ij,ij->i", fa[r, :steps[1]], fb[c, :steps[1]])
            go_on = part + rest[0][1][r] * rest[1][1][c] >= least
            r, c = r[go_on], c[go_on]
            hit = np.einsum("ij,ij->i", a[r], b[c]) >= cosine
            if hit.any():
                yield r[hit], c[hit]


def _compare(turn: np.ndarray, cosine: float, tiles: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        tile = table["tile"].to_numpy()
        one, other = divmod(table["pair"][0].as_py(), tiles)
        same = one == other
        left, right = np.flatnonzero(tile == one), np.flatnonzero(tile == other)
        node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        x = matrix(table["embedding"])
        links = np.zeros(len(node), np.int64)

        def pairs():
            for r, c in similar(x[left], x[right], turn, cosine, same):
                r, c = left[r], right[c]
                np.add.at(links, r, copies[c])
                np.add.at(links, c, copies[r])
                yield from zip(node[r].tolist(), node[c].tolist())

        kept = forest(pairs())
        some = links > 0
        a = [*node[some].tolist(), *(p[0] for p in kept)]
        b = [None] * int(some.sum()) + [p[1] for p in kept]
        n = [*links[some].tolist(), *([None] * len(kept))]
        return pa.table([pa.array(v, pa.int64()) for v in (a, b, n)], schema=schema)
    return run


def links(nodes: DataFrame, cosine: float = COSINE, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Of vectors (node, copies, embedding) of one length: rows (a, null, n), n vectors are linked
    to a, in part sums; and rows (a, b, null), enough links to connect all that are linked."""
    turn = axes(nodes)
    placed = settle(arrow(nodes, _first_axis(np.ascontiguousarray(turn[:, 0])),
                          "node long, copies long, embedding array<double>, place double"), "placed")
    tiles = max(1, -(-placed.count() // tile_rows))
    cuts = np.array([]) if tiles == 1 else np.unique(placed.select(F.percentile_approx(
        "place", [k / tiles for k in range(1, tiles)], 100 * tiles)).first()[0])
    dealt = arrow(placed, _deal(cuts, cosine),
                  "pair long, tile long, node long, copies long, embedding array<double>")
    return dealt.groupBy("pair").applyInArrow(_compare(turn, cosine, len(cuts) + 1),
                                              "a long, b long, n long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    ship(vectors.sparkSession)
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) &
                      (F.abs(v) < float("inf")))
    sound = F.coalesce(finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    whole = rows.where(sound)
    nodes = settle(whole.groupBy("embedding")
                   .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
                   .withColumn("node", F.monotonically_increasing_id()), "nodes")
    size = F.size("embedding")
    found = None
    for (length,) in nodes.select(size).distinct().collect():
        part = links(nodes.where(size == length).select("node", "copies", "embedding"), cosine)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "a long, b long, n long")
    found = settle(found, "links")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b"))
    graph = (nodes.join(roots, "node", "left").join(counts, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    named = graph.groupBy("root").agg(F.min("first").alias("component_id"))
    judged = graph.join(named, "root").select(
        "embedding", "component_id",
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    return (whole.join(judged, "embedding").select("vec_id", "n_links", "component_id")
            .unionByName(rows.where(~sound).select(
                "vec_id", F.lit(0).cast("long").alias("n_links"),
                F.col("vec_id").alias("component_id")))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
