"""Language-model scores by deleted interpolation of word pairs and words.

The probability of a word after another is a mixture of the pair's relative frequency and the
smoothed frequency of the word alone. The weight of the pair depends on how often the context was
seen: contexts fall into buckets of counts that double, and each bucket's weight is found by
expectation-maximisation on held-out counts, those of a tenth of the learning documents, whose
own counts are deleted from the totals before their pairs are predicted.

All counts are of the whole corpus. Documents are dealt to blocks of some megabytes by a hash of
their rows. A block asks for the totals of its distinct words and pairs, as sorted arrays of
hashes, one for each range of hashes; a range adds up what all blocks have, and answers each.
So a frequent word is one entry per block, not one per occurrence, no task holds more than a
block or a range, and both stay the same size when the corpus grows. EM needs only how often each
ratio of the two estimates occurs in a bucket, a table of fixed size (ratios are rounded to a
thousandth of a decade).

Words and pairs are told apart by 64-bit hashes.

Rows: null and empty texts are the end token alone. Repeated rows and rows without an id count and
are scored one by one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradegrain.llm.frames import arrow, in_fold, ship, text_bytes
from tradegrain.llm.words import NON_SPACE, each_piece, mix
from tradegrain.session import settle

BLOCK_BYTES = 4 << 20
SMOOTHING = 0.1
MODULUS, HELD, DELETED = 10, 0, 1     # remainders of the test texts and of the deleted part
BINS = 1000                           # of a decade of ratios
ROUNDS = 200
END, BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_WORDS, _PAIRS = 0, 1


class Block:
    """The tokens of a block's documents: hashes of words, and of pairs with the word before."""

    def __init__(self, texts: pa.Array):
        tokens, counts = [], []
        for _, _, words in each_piece(texts, NON_SPACE, lower=True):
            tokens.append(np.insert(words.hashes(), words.first[1:], END))
            counts.append(words.lengths() + 1)
        token = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        self.sizes = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        before = np.concatenate(([BEGIN], token[:-1])).astype(np.uint64)[:len(token)]
        before[self.starts] = BEGIN
        self.words, self.word = np.unique(token, return_inverse=True)
        self.pairs, self.pair = np.unique(mix(before, token), return_inverse=True)
        self.first = np.zeros(len(token), bool)
        self.first[self.starts] = True

    def kinds(self):
        return ((_WORDS, self.words, self.word), (_PAIRS, self.pairs, self.pair))


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed: the high planes of small ones are empty."""
    kind = values.dtype.newbyteorder("<")
    return zstandard.compress(
        values.astype(kind).view(np.uint8).reshape(len(values), -1).T.tobytes(), 1)


def _unplanes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def _ranges(values: np.ndarray, count: int) -> np.ndarray:
    """Where each of `count` equal ranges of hashes begins among sorted `values`, and the end."""
    edges = np.array([(i << 64) // count for i in range(count)], np.uint64)
    return np.append(np.searchsorted(values, edges), len(values))


def _packed(batches):
    """The documents of a batch that belong to one block, compressed, as one row."""
    for batch in batches:
        block = batch.column(0).to_numpy()
        order = np.argsort(block, kind="stable")
        distinct, start = np.unique(block[order], return_index=True)
        rows = batch.select([1, 2, 3]).take(pa.array(order))
        packs = []
        for low, high in zip(start, [*start[1:], len(order)]):
            sink = pa.BufferOutputStream()
            part = rows.slice(low, high - low)
            with pa.ipc.new_stream(sink, part.schema) as out:
                out.write_batch(part)
            packs.append(zstandard.compress(sink.getvalue().to_pybytes(), 3))
        yield pa.RecordBatch.from_arrays([pa.array(distinct, pa.int64()),
                                          pa.array(packs, pa.binary())], names=["block", "pack"])


def _unpacked(table: pa.Table) -> pa.Table:
    """A block's documents. Their order does not matter: hashes are sorted."""
    parts = [pa.ipc.open_stream(zstandard.decompress(p.as_py())).read_all() for p in table["pack"]]
    return pa.concat_tables(parts).combine_chunks()


def _requests(ranges: int):
    def run(table: pa.Table) -> pa.Table:
        number = table["block"][0].as_py()
        docs = _unpacked(table)
        block = Block(docs["text"])
        learn = np.repeat(docs["learn"].to_numpy().astype(np.int64), block.sizes)
        out = [[], [], [], [], []]
        for kind, keys, at in block.kinds():
            n = np.bincount(at, weights=learn, minlength=len(keys)).astype(np.uint32)
            cuts = _ranges(keys, ranges)
            for r in np.flatnonzero(np.diff(cuts)).tolist():
                own = slice(cuts[r], cuts[r + 1])
                for column, value in zip(out, (r, number, kind, _planes(
                        np.diff(keys[own], prepend=np.uint64(0))), _planes(n[own]))):
                    column.append(value)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                         pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary()),
                         pa.array(out[4], pa.binary())],
                        names=["range", "block", "kind", "hashes", "counts"])
    return run


def _totals(deleted_from: int):
    """Answers a range: for each request the totals, over all and over the deleted part; and one
    row (block -1) with the range's tokens, those of the deleted part, and its distinct words."""
    def run(table: pa.Table) -> pa.Table:
        blocks, kinds = table["block"].to_numpy(), table["kind"].to_numpy()
        rows, tokens, gone, distinct = [], 0, 0, 0
        for kind in (_WORDS, _PAIRS):
            own = np.flatnonzero(kinds == kind).tolist()
            if not own:
                continue
            keys = [np.cumsum(_unplanes(table["hashes"][i].as_py(), "<u8"), dtype=np.uint64)
                    for i in own]
            counts = np.concatenate([_unplanes(table["counts"][i].as_py(), "<u4") for i in own])
            sizes = np.array([len(k) for k in keys])
            known, at = np.unique(np.concatenate(keys), return_inverse=True)
            deleted = np.repeat(blocks[own] >= deleted_from, sizes)
            total = np.bincount(at, weights=counts)
            part = np.bincount(at, weights=counts * deleted, minlength=len(known))
            if kind == _WORDS:
                tokens, gone, distinct = int(total.sum()), int(part.sum()), int((total > 0).sum())
            for i, mine in zip(own, np.split(at, np.cumsum(sizes)[:-1])):
                rows.append((int(blocks[i]), kind, _planes(total[mine].astype(np.uint64)),
                             _planes(part[mine].astype(np.uint64))
                             if blocks[i] >= deleted_from else b"", 0, 0, 0))
        rows.append((-1, _WORDS, b"", b"", tokens, gone, distinct))
        number = table["range"][0].as_py()
        columns = list(zip(*rows))
        return pa.table([pa.array([number] * len(rows), pa.int64()),
                         pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                         pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary()),
                         *(pa.array(c, pa.int64()) for c in columns[4:])],
                        names=["range", "block", "kind", "totals", "deleted", "tokens", "gone",
                               "words"])
    return run


def _answered(block: Block, table: pa.Table, column: str) -> list[np.ndarray]:
    """Totals of the block's words and pairs, in the order of their hashes."""
    table = table.sort_by([("kind", "ascending"), ("range", "ascending")])
    kinds = table["kind"].to_numpy()
    out = []
    for kind, keys, _ in block.kinds():
        parts = [_unplanes(table[column][i].as_py(), "<u8")
                 for i in np.flatnonzero(kinds == kind).tolist()]
        out.append(np.concatenate(parts).astype(np.float64) if parts else np.zeros(len(keys)))
    return out


def _estimates(block: Block, words, pairs, tokens: int, distinct: int, texts: int):
    """Of each token: the pair's relative frequency, the word's, the count of the context."""
    count = words[block.word]
    context = np.concatenate(([0.0], count[:-1]))[:len(count)]
    context[block.first] = texts
    alone = (count + SMOOTHING) / (tokens + SMOOTHING * (distinct + 1))
    pair = np.divide(pairs[block.pair], context, out=np.zeros(len(count)), where=context > 0)
    return pair, alone, context


def bucket(context: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(context + 1)).astype(np.int64)


def _ratios(tokens: int, distinct: int, texts: int):
    """(bucket, rounded ratio, how often) of the deleted documents' tokens; -1 << 30: no pair."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        docs = _unpacked(left)
        block = Block(docs["text"])
        totals, own = (_answered(block, right, c) for c in ("totals", "deleted"))
        words, pairs = (a - b for a, b in zip(totals, own))
        pair, alone, context = _estimates(block, words, pairs, tokens, distinct, texts)
        step = np.full(len(pair), -1 << 30, np.int64)
        some = pair > 0
        step[some] = np.round(BINS * np.log10(pair[some] / alone[some]))
        seen = context > 0
        rows, n = np.unique(np.stack([bucket(context[seen]), step[seen]]), axis=1,
                            return_counts=True)
        return pa.table([pa.array(rows[0]), pa.array(rows[1]), pa.array(n)],
                        names=["bucket", "step", "n"])
    return run


def weights(rows: list[tuple[int, int, int]]) -> dict[int, float]:
    """EM for the weight of pairs in every bucket, from (bucket, step, how often)."""
    out = {}
    for b in sorted({r[0] for r in rows}):
        step, n = (np.array([r[k] for r in rows if r[0] == b], np.float64) for k in (1, 2))
        ratio = np.where(step > -(1 << 29), 10.0 ** (np.maximum(step, -300 * BINS) / BINS), 0.0)
        weight = 0.5
        for _ in range(ROUNDS):
            share = weight * ratio / (weight * ratio + 1 - weight)
            weight = min(float((n * share).sum() / n.sum()), 1 - 1e-6)
        out[b] = weight
    return out


def _scores(tokens: int, distinct: int, texts: int, mixture: dict[int, float]):
    table_of = np.zeros(66)
    # A bucket without a held-out token takes the weight of the nearest rarer one.
    last = 0.0
    for b in range(1, 66):
        last = table_of[b] = mixture.get(b, last)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        docs = _unpacked(left)
        block = Block(docs["text"])
        words, pairs = _answered(block, right, "totals")
        pair, alone, context = _estimates(block, words, pairs, tokens, distinct, texts)
        weight = table_of[bucket(context)]
        both = np.log10(weight * pair + (1 - weight) * alone)

        def summed(values):
            return np.add.reduceat(values, block.starts) if len(values) else values

        return pa.table([docs["doc_id"], pa.array(block.sizes),
                         pa.array(summed((words[block.word] > 0).astype(np.int64))),
                         pa.array(summed(np.log10(alone))), pa.array(summed(both))],
                        names=["doc_id", "n_tokens", "n_known", "base_score", "score"])
    return run


def score(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and
    score, the log10 probabilities under smoothed words and under the mixture."""
    ship(docs.sparkSession)
    held_out, deleted = (in_fold("doc_id", MODULUS, r) for r in (HELD, DELETED))
    narrow = docs.select("doc_id", "text")
    blocks = max(1, math.ceil(text_bytes(narrow) / block_bytes))
    few = math.ceil(blocks / MODULUS)
    deal = F.xxhash64("doc_id", "text")
    texts = narrow.select(
        F.when(deleted, blocks + F.pmod(deal, F.lit(few))).otherwise(
            F.pmod(deal, F.lit(blocks))).alias("block"),
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), (~held_out).alias("learn"))
    learners, deleted_learners = narrow.where(~held_out).agg(
        F.count(F.lit(1)), F.count_if(deleted)).first()
    packed = arrow(texts, _packed, "block long, pack binary")
    requests = packed.groupBy("block").applyInArrow(
        _requests(blocks),
        "range long, block long, kind int, hashes binary, counts binary")
    answers = settle(requests.groupBy("range").applyInArrow(
        _totals(blocks), "range long, block long, kind int, totals binary, deleted binary, "
                         "tokens long, gone long, words long"), "totals")
    tokens, gone, distinct = answers.where("block = -1").agg(
        *(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "gone", "words"))).first()
    asked = answers.where("block >= 0").select("range", "block", "kind", "totals", "deleted")

    held = packed.where(F.col("block") >= blocks).groupBy("block").cogroup(
        asked.where(F.col("block") >= blocks).groupBy("block"))
    ratios = held.applyInArrow(_ratios(tokens - gone, distinct, learners - deleted_learners),
                               "bucket long, step long, n long")
    mixture = weights([tuple(r) for r in ratios.groupBy("bucket", "step").agg(
        F.sum("n").alias("n")).collect()])     # of fixed size: buckets x rounded ratios
    scored = packed.groupBy("block").cogroup(
        asked.drop("deleted").groupBy("block")).applyInArrow(
        _scores(tokens, distinct, learners, mixture),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", in_fold("doc_id", MODULUS, HELD).alias("held_out"), "n_tokens", "n_known",
                         F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
