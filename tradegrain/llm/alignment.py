"""Alignment of two tokenizers' tokens over the same bytes, by merge-path partitioning.

Tokenizer A reads a space and the text; tokenizer B reads the text and adds the space itself. Both
lists of token ends are sorted, so merging them walks from boundary to boundary, and every stretch
between two boundaries is one link: the A token and the B token that cover it. A boundary at which
both end closes a group.

A document's merge is cut into pieces of `WORK` steps by a binary search on each diagonal of the
two lists; a piece holds the ids it needs and how far into its first tokens it begins, so that any
task can merge it alone. Pieces are written; passes over them count the links of each pair of ids,
and then look the counts up. A piece whose document goes on leaves the text of its groups, and
those of a document are stitched where they meet.

Pairs come in at most (ids of A) x (ids of B) kinds, whatever the corpus; the counts go to the
pieces `PAIRS` at a time, in as many rounds as that takes, each with one broadcast and written
before the next. A task merges about `CHUNK` tokens at once.

Rows: each row is a document, repeated rows too. A text that is null or empty, or whose tokens do
not give its bytes back, has no tokens: zeros and an empty checksum. A text of any length is one
row of the tokenizers' pass and many pieces after it. Other columns are not read. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradegrain.llm.frames import arrow
from tradegrain.llm.words import buffers, pieces
from tradegrain.session import scratch_path, settle

WORK = 1 << 16       # steps of a merge in a piece
CHUNK = 1 << 20      # tokens that a task merges at once
PAIRS = 4 << 20      # pairs of ids in a broadcast, 17 bytes each
_SUMS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
_MANY_SPACES = re.compile(r"\s{1000}")
# How byte-level tokens write bytes: printable ones stand for themselves, others from U+0100 on.
_AS_ITSELF = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _byte_of() -> dict[str, int]:
    rest = [b for b in range(256) if b not in set(_AS_ITSELF)]
    return {chr(b): b for b in _AS_ITSELF} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_definition: str, b_model: bytes):
        byte_of = _byte_of()
        vocab = json.loads(a_definition)["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            plain = all(c in byte_of for c in token)
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if plain else token.encode()
        # Merges are numbered in their order, so ids are ranks, and the rank-based encoder gives
        # the same ids; the other reads what that one's splitter cannot, long white space.
        self.slow = Tokenizer.from_str(a_definition)
        self.slow.encode_special_tokens = True
        special = set(t["content"] for t in json.loads(a_definition).get("added_tokens", []))
        self.fast = tiktoken.Encoding(
            "a", pat_str=public_tokenizers.PATTERN, special_tokens={},
            mergeable_ranks={self.a_bytes[i]: i for t, i in vocab.items() if t not in special})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                        else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.vocab_size())))]
        self.sizes = tuple(np.array([len(t) for t in tokens], np.int64)
                           for tokens in (self.a_bytes, self.b_bytes))

    def encode(self, texts: list[bytes]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of A and B; none where either does not give the bytes back."""
        read = [t.decode() for t in texts]
        for text, raw, b in zip(read, texts, self.b.encode(read, num_threads=1)):
            whole = b" " + raw
            if not raw or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
                yield [], []
                continue
            if _MANY_SPACES.search(text):
                a = self.slow.encode(" " + text, add_special_tokens=False).ids
            else:
                a = self.fast.encode_ordinary(" " + text)
            yield (a, b) if b"".join(map(self.a_bytes.__getitem__, a)) == whole else ([], [])


@lru_cache(1)
def pair_of(a_definition: str, b_model: bytes) -> Pair:
    return Pair(a_definition, b_model)


def diagonals(a: np.ndarray, b: np.ndarray, work: int) -> np.ndarray:
    """The merged boundaries that end every `work` steps of merging two sorted lists: for each
    diagonal, the number of `a` among its steps is found by bisection. The last is the end."""
    step = np.arange(work, len(a) + len(b), work)
    low, high = np.maximum(step - len(b), 0), np.minimum(step, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        first = np.zeros(len(step), bool)
        at = middle[open_]
        first[open_] = a[at] <= b[step[open_] - 1 - at]
        low = np.where(open_ & first, middle + 1, low)
        high = np.where(open_ & ~first, middle, high)
    of_a = np.where(low > 0, a[np.maximum(low, 1) - 1], 0)
    of_b = np.where(step - low > 0, b[np.maximum(step - low, 1) - 1], 0)
    return np.unique(np.append(np.maximum(of_a, of_b), a[-1:]))


def cut(a: np.ndarray, b: np.ndarray, sizes: tuple, work: int) -> list[tuple]:
    """Pieces of a document: (a, b, a_skip, b_skip), its ids and how many bytes of the first ones
    came before. A token across a cut stands on both sides."""
    if len(a) + len(b) <= work:
        return [(a, b, 0, 0)]
    ends = np.cumsum(sizes[0][a]), np.cumsum(sizes[1][b])
    out, low = [], 0
    for high in diagonals(*ends, work).tolist():
        part = []
        for ids, end in zip((a, b), ends):
            first, last = np.searchsorted(end, low, "right"), np.searchsorted(end, high, "left")
            part.append((ids[first:last + 1], low - (int(end[first - 1]) if first else 0)))
        out.append((part[0][0], part[1][0], part[0][1], part[1][1]))
        low = high
    return out


def _pieces(a_definition: str, b_model: bytes, work: int, kind: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(a_definition, b_model)
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            for low, high in pieces(offsets, CHUNK):
                texts = [data[s:e].tobytes() for s, e in zip(offsets[low:high],
                                                             offsets[low + 1:high + 1])]
                rows: list[list] = [[] for _ in range(7)]
                for i, (a, b) in enumerate(pair.encode(texts)):
                    parts = cut(np.array(a, kind), np.array(b, kind), pair.sizes, work)
                    for number, (own_a, own_b, skip_a, skip_b) in enumerate(parts):
                        for column, value in zip(rows, (low + i, number, len(parts),
                                                        own_a.tobytes(), own_b.tobytes(),
                                                        skip_a, skip_b)):
                            column.append(value)
                at = pa.array(rows[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at),
                     *(pa.array(c, pa.int64()) for c in rows[1:3]),
                     *(pa.array(c, pa.binary()) for c in rows[3:5]),
                     *(pa.array(c, pa.int64()) for c in rows[5:7])],
                    names=["row", "doc_id", "piece", "pieces", "a", "b", "a_skip", "b_skip"])
    return run


class Merged:
    """The merge of a run of pieces, all at once: their bytes are laid end to end."""

    def __init__(self, batch: pa.RecordBatch, sizes: tuple, kind: str):
        n = len(batch)
        ids, own_ends, counts = [], [], []
        for name, size in zip("ab", sizes):
            column = batch.column(batch.schema.get_field_index(name))
            skips = batch.column(batch.schema.get_field_index(f"{name}_skip")).to_numpy()
            data, offsets = buffers(column)
            found = np.frombuffer(data.tobytes(), kind)
            first = offsets // np.dtype(kind).itemsize
            total = np.concatenate([[0], np.cumsum(size[found])])
            number = np.diff(first)
            ids.append(found)
            counts.append(number)
            # Ends from where the piece begins.
            own_ends.append(total[1:] - np.repeat(total[first[:-1]] + skips, number))
        lasts = []
        for ends, number in zip(own_ends, counts):
            last = np.zeros(n, np.int64)
            last[number > 0] = ends[np.cumsum(number)[number > 0] - 1]
            lasts.append(last)
        self.size = np.minimum(*lasts)                        # bytes of each piece
        self.edge = np.concatenate([[0], np.cumsum(self.size)])
        self.ids, self.ends, self.ended = [], [], []
        for found, ends, number in zip(ids, own_ends, counts):
            piece = np.repeat(np.arange(n), number)
            whole = ends <= self.size[piece]                  # the last may go on in the next piece
            self.ids.append(found)
            self.ends.append(np.minimum(ends, self.size[piece]) + self.edge[piece])
            self.ended.append(whole)
        a, b = self.ends
        at = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
        both = b[at] == a if len(b) else np.zeros(0, bool)
        alone = np.ones(len(b), bool)
        alone[at[both]] = False
        self.stops = np.sort(np.concatenate([a, b[alone]]), kind="stable")
        self.of_a, self.of_b = np.searchsorted(a, self.stops), np.searchsorted(b, self.stops)
        self.cuts = a[both & self.ended[0] & (self.ended[1][at] if len(b) else False)]

    def pairs(self) -> np.ndarray:
        """The pair of each link, b in the upper half."""
        return (self.ids[1][self.of_b].astype(np.int64) << 32) | self.ids[0][self.of_a]

    def per_piece(self, positions: np.ndarray) -> np.ndarray:
        """Where each piece begins in a list of sorted positions, and the end."""
        return np.searchsorted(positions, self.edge, "right")

    def groups(self) -> tuple[pa.Array, np.ndarray]:
        """Each piece's groups as text, and whether its last one is closed."""
        ends = np.union1d(self.cuts, self.edge[1:])
        ends = ends[ends > 0]
        sides = []
        for ids, at, whole in zip(self.ids, self.ends, self.ended):
            offsets = np.concatenate([[0], np.searchsorted(at[whole], ends, "right")])
            words = _decimals().take(pa.array(ids[whole].astype(np.int32)))
            sides.append(pc.binary_join(pa.ListArray.from_arrays(offsets.astype(np.int32), words), ","))
        each = pc.binary_join_element_wise(*sides, "|")
        firsts = np.searchsorted(ends, self.edge, "right").astype(np.int32)
        lists = pa.ListArray.from_arrays(firsts, each)
        return pc.binary_join(lists, ";"), np.isin(self.edge[1:], self.cuts)


@lru_cache(1)
def _decimals() -> pa.Array:
    return pa.array(np.arange(1 << 17)).cast(pa.string())


def _chunks(batch: pa.RecordBatch, kind: str) -> Iterator[pa.RecordBatch]:
    sizes = sum(pc.binary_length(batch.column(batch.schema.get_field_index(c)))
                .to_numpy(zero_copy_only=False).astype(np.int64) for c in "ab")
    ends = np.concatenate([[0], np.cumsum(sizes)])
    for low, high in pieces(ends, CHUNK * np.dtype(kind).itemsize):
        yield batch.slice(low, high - low)


def _links(sizes: tuple, kind: str) -> Callable:
    """Rows (pair, n), summed over about four chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def flush() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n, pa.int64())],
                                              names=["pair", "n"])
        for batch in batches:
            for chunk in _chunks(batch, kind):
                held.append(Merged(chunk, sizes, kind).pairs())
                count += len(held[-1])
                if count > 4 * CHUNK:
                    yield flush()
                    held, count = [], 0
        if held:
            yield flush()
    return run


def _measured(sizes: tuple, kind: str, counts, whole: bool) -> Callable:
    """Sums of each piece over the links whose pair is among `counts`; with `whole` also the other
    numbers, the checksum of a document of one piece, and the groups of a piece of several."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number, best = counts.value
        for batch in batches:
            for chunk in _chunks(batch, kind):
                merged = Merged(chunk, sizes, kind)
                met, back = np.unique(merged.pairs(), return_inverse=True)
                at = np.minimum(np.searchsorted(known, met), max(len(known) - 1, 0))
                mine = known[at] == met if len(known) else np.zeros(len(met), bool)
                first = merged.per_piece(merged.stops)
                sums = []
                for values in (best, number):
                    own = np.where(mine, values[at], 0).astype(np.int64) if len(known) \
                        else np.zeros(len(met), np.int64)
                    total = np.concatenate([[0], np.cumsum(own[back])])
                    sums.append(pa.array(total[first[1:]] - total[first[:-1]]))
                head = [chunk.column(0), chunk.column(2)]
                if not whole:
                    yield pa.RecordBatch.from_arrays([*head, *sums],
                                                     names=["row", "piece", "n_best", "count_sum"])
                    continue
                ended = [np.diff(merged.per_piece(e[w]))
                         for e, w in zip(merged.ends, merged.ended)]
                text, closed = merged.groups()
                single = chunk.column(3).to_numpy() == 1
                text = [x.encode() for x in text.to_pylist()]
                shas = [hashlib.sha256(t).hexdigest() if t else "" for t in text]
                yield pa.RecordBatch.from_arrays(
                    [*head, chunk.column(1), chunk.column(3), pa.array(ended[0]),
                     pa.array(ended[1]), pa.array(np.diff(merged.per_piece(merged.cuts))),
                     pa.array(np.diff(first)), *sums,
                     pa.array([x if s else None for x, s in zip(shas, single)], pa.string()),
                     pa.array([None if s else t.decode() for t, s in zip(text, single)],
                              pa.string()), pa.array(closed)],
                    names=["row", "piece", "doc_id", "pieces", *_SUMS, "groups_sha256", "groups",
                           "closed"])
    return run


def stitch(parts: list[tuple[str, bool]]) -> str:
    """The groups of a document from those of its pieces; a piece that is not closed shares its
    last group with the first of the next."""
    done, rest = [], ""
    for text, closed in parts:
        if rest:
            head, more, text = text.partition(";")
            sides = [",".join(filter(None, s)) for s in zip(rest.split("|"), head.split("|"))]
            text = "|".join(sides) + more + text
            rest = ""
        if not closed:
            text, _, rest = text.rpartition(";")
        if text:
            done.append(text)
    return ";".join([*done, *([rest] if rest else [])])


def _stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at = ["row", "doc_id", *_SUMS]
    for batch in batches:
        found = []
        for parts in batch.column(batch.schema.get_field_index("parts")):
            text = stitch([(p["groups"], p["closed"])
                           for p in sorted(parts.as_py(), key=lambda p: p["piece"])])
            found.append(hashlib.sha256(text.encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c))
                                            for c in at), pa.array(found, pa.string())],
                                         names=[*at, "groups_sha256"])


def align(docs: DataFrame, a_tokenizer: str | None = None, b_tokenizer: str | None = None,
          work: int = WORK, pairs: int = PAIRS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_a and n_b tokens, n_groups, n_links, n_best (links
    whose count is the highest of their B id), count_sum and groups_sha256."""
    spark = docs.sparkSession
    a_definition = Path(a_tokenizer or public_tokenizers.path("byte_bpe_50k.json")) \
        .read_text(encoding="utf-8")
    b_model = Path(b_tokenizer or public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    sizes = Pair(a_definition, b_model).sizes
    kind = "<u2" if max(map(len, sizes)) <= 1 << 16 else "<u4"

    numbered = docs.select(F.monotonically_increasing_id().alias("row"),
                           F.col("doc_id").cast("long").alias("doc_id"), "text")
    path = scratch_path(spark, "aligned_pieces")
    arrow(numbered, _pieces(a_definition, b_model, work, kind),
          "row long, doc_id long, piece long, pieces long, a binary, b binary, a_skip long, "
          "b_skip long").write.option("compression", "zstd").parquet(path)
    cuts = spark.read.parquet(path)

    linked = (arrow(cuts.select("a", "b", "a_skip", "b_skip"), _links(sizes, kind),
                    "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    counted = settle(linked.withColumn("b", F.shiftright("pair", 32)), "linked_pairs")
    # As many rows as B has ids, at most.
    most = counted.groupBy("b").agg(F.max("n").alias("most"))
    judged = settle(counted.join(F.broadcast(most), "b")
                    .select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")
    rounds = max(1, -(-judged.count() // pairs))
    sums = ", ".join(f"{c} long" for c in _SUMS)
    measured, later = None, []
    for i in range(rounds):
        # Rounds are ranges of a hash, so that each has about as many pairs.
        part = judged.where(F.pmod(F.xxhash64("pair"), F.lit(rounds)) == i).toArrow()
        part = part.sort_by("pair")
        held = spark.sparkContext.broadcast(tuple(
            part.column(c).cast(t).combine_chunks().to_numpy(zero_copy_only=False)
            for c, t in (("pair", pa.int64()), ("n", pa.int64()), ("best", pa.int8()))))
        schema = "row long, piece long, n_best long, count_sum long" if i else \
            f"row long, piece long, doc_id long, pieces long, {sums}, groups_sha256 string, " \
            "groups string, closed boolean"
        columns = ["row", "doc_id", "piece", "pieces", "a", "b", "a_skip", "b_skip"]
        done = settle(arrow(cuts.select(*columns), _measured(sizes, kind, held, not i), schema),
                      "aligned")
        held.destroy()
        if i:
            later.append(done)
        else:
            measured = done
    if later:
        more = later[0]
        for x in later[1:]:
            more = more.unionByName(x)
        more = (more.unionByName(measured.select(*more.columns)).groupBy("row", "piece")
                .agg(*(F.sum(c).alias(c) for c in ("n_best", "count_sum"))))
        measured = measured.drop("n_best", "count_sum").join(more, ["row", "piece"])
    names = ["doc_id", *_SUMS, "groups_sha256"]
    parts = (measured.where("pieces > 1").groupBy("row", "doc_id")
             .agg(*(F.sum(c).alias(c) for c in _SUMS),
                  F.collect_list(F.struct("piece", "groups", "closed")).alias("parts")))
    whole = arrow(parts, _stitched, f"row long, doc_id long, {sums}, groups_sha256 string")
    return measured.where("pieces = 1").select(*names).unionByName(whole.select(*names))
