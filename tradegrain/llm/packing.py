"""Packing into token sequences by power-of-two decomposition.

A document's tokens are cut into pieces whose lengths are powers of two: as many of the longest
length as fit, then the binary digits of what is left. A piece is a sequence of its own, so no
sequence crosses documents and none needs padding; sequences of one length are numbered one after
the other (`bucket`), so that a trainer reads them in batches of equal shape.

Words between ASCII spaces are tokenized apart, which gives the same tokens since the tokenizer
never joins across white space; a Python worker tokenizes a word once as long as it remembers it.
Words are remembered by 64-bit hashes: by chance two among n share one with n^2 / 2^65, and a worker
forgets all beyond `_KNOWN_WORDS`.

Rows: null and empty texts are one piece, the end token. Repeated rows are packed each.
"""

from __future__ import annotations

import zlib
from functools import cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType
from tokenizers import Tokenizer

from tradegrain.llm.frames import arrow
from tradegrain.llm.words import NON_SPACE, Words, buffers, pieces
from tradegrain.operators.numbering import number_rows
from tradegrain.session import settle

LONGEST = 4096
END = 2
_KNOWN_WORDS = 1_000_000 # tokenized words that a Python worker remembers, some 30 bytes each
_LAYERS = 8              # tables that they are looked up in; more are merged
_JOINED = 1000           # new words that are tokenized in one call
_SPECIAL = b"<|"         # may begin a special token, whose capitals count


class Encoder:
    """Token ids of texts, word by word, remembering the words it has met by their hashes."""

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        # Tables of remembered words: hashes (sorted), where each one's ids begin, how many, ids.
        self.known: list[tuple[np.ndarray, ...]] = []
        # A special token between words keeps them apart in one call.
        self.between = next(((i, t.content) for i, t in
                             self.tokenizer.get_added_tokens_decoder().items()
                             if t.content.encode().startswith(_SPECIAL)), None)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(found.ids, np.uint32)
                for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[np.ndarray]:
        if self.between is None:
            return self.whole(words)
        mark, text = self.between
        out: list[np.ndarray] = []
        for low in range(0, len(words), _JOINED):
            ids = self.whole([text.join(words[low:low + _JOINED])])[0]
            ends = np.flatnonzero(ids == mark)
            out += [x[x != mark] for x in np.split(ids, ends)]
        return out

    def _look_up(self, met: np.ndarray, word) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each hash begin and how many they are, and the ids; `word` gives the
        text of the i-th hash, if it is new."""
        if sum(len(keys) for keys, *_ in self.known) > _KNOWN_WORDS:
            self.known.clear()
        elif len(self.known) >= _LAYERS:
            base = np.cumsum([0, *(len(flat) for *_, flat in self.known)])
            keys, start, size, flat = map(np.concatenate, zip(*(
                (k, s + b, n, f) for (k, s, n, f), b in zip(self.known, base.tolist()))))
            order = np.argsort(keys)
            self.known = [(keys[order], start[order].astype(np.int32), size[order], flat)]
        left, base = np.arange(len(met)), 0
        starts, sizes = np.zeros(len(met), np.int64), np.zeros(len(met), np.int64)
        for keys, start, size, flat in self.known:
            at = np.minimum(np.searchsorted(keys, met[left]), len(keys) - 1)
            hit = keys[at] == met[left]
            starts[left[hit]] = base + start[at[hit]]
            sizes[left[hit]] = size[at[hit]]
            left, base = left[~hit], base + len(flat)
        if len(left):
            own = self._words([word(i) for i in left.tolist()])
            size = np.array([len(x) for x in own], np.int32)
            start = (np.cumsum(size) - size).astype(np.int32)
            starts[left], sizes[left] = base + start, size
            self.known.append((met[left], start, size, np.concatenate(own)))
        return starts, sizes, np.concatenate([np.zeros(0, np.uint32), *(f for *_, f in self.known)])

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of UTF-8 texts laid end to end: all ids, and where each text's begin (one more)."""
        # Capitals go first: the tokenizer lowers them all, and words are then met more often. One
        # with a byte outside ASCII behind it stays, as it may compose before it is lowered.
        after = np.append(data[1:], np.uint8(0)) >= 128
        low = np.where((data >= 65) & (data <= 90) & ~after, data | 32, data)
        words = Words(low, offsets, NON_SPACE, lower=False)
        # A word and the one comma or full stop after it are tokenized apart anyway.
        last, before = low[words.ends - 1], low[words.ends - 2]
        sign = words.ends[((last == 44) | (last == 46)) & (words.ends - words.starts > 1)
                          & (before >= 97) & (before <= 122)] - 1
        words.starts = np.sort(np.concatenate([words.starts, sign]))
        words.ends = np.sort(np.concatenate([words.ends, sign]))
        words.first = np.searchsorted(words.starts, offsets)
        met, at, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
        start, size, flat = self._look_up(met, lambda i: words.word(at[i]).decode())
        # The ids of all words in their order.
        sizes = size[back]
        ends = np.cumsum(sizes)
        place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start[back] - ends + sizes,
                                                                        sizes)
        return flat[place], np.concatenate([[0], ends])[words.first]

    def each(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids of each text."""
        ids, first = self.ids(data, offsets)
        out = [ids[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        if _SPECIAL in data.tobytes():
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                if _SPECIAL in (text := data[a:b].tobytes()):
                    out[i] = self.whole([text.decode()])[0]
        return out


@cache
def encoder(definition: str) -> Encoder:
    return Encoder(definition)


def lengths(tokens: int, longest: int) -> list[int]:
    """Powers of two that add up to `tokens`, falling."""
    rest = tokens % longest
    return [longest] * (tokens // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1)
                                              if rest >> b & 1]


def pieces_of(docs: DataFrame, definition: str, longest: int = LONGEST, end: int = END,
              with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, bucket (its power of two),
    and the ids themselves unless `with_ids` is False."""
    if longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    names = ["start", "length", "ids_crc32", "doc_tokens"]
    schema = StructType([docs.schema["doc_id"], *(StructField(n, LongType()) for n in names),
                         *([StructField("ids", ArrayType(IntegerType()))] if with_ids else [])])

    def run(batches):
        known = encoder(definition)
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for low, high in pieces(offsets):
                row, found, ids = [], [[], [], [], []], []
                edge = offsets[low:high + 1]
                for i, own in enumerate(known.each(data[edge[0]:edge[-1]], edge - edge[0])):
                    own = np.append(own, np.uint32(end)).astype("<u4")
                    start = 0
                    for size in lengths(len(own), longest):
                        cut = own[start:start + size]
                        row.append(low + i)
                        for column, value in zip(found, (start, size, zlib.crc32(cut), len(own))):
                            column.append(value)
                        if with_ids:
                            ids.append(cut)
                        start += size
                arrays = [batch.column(0).take(pa.array(row, pa.int64())),
                          *(pa.array(c, pa.int64()) for c in found)]
                if with_ids:
                    ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                    flat = np.concatenate(ids).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(ends, pa.array(flat)))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return (arrow(docs.select("doc_id", "text"), run, schema)
            .withColumn("bucket", F.log2("length").cast("int")))


def pack(docs: DataFrame, tokenizer: str | None = None, longest: int = LONGEST, end: int = END,
         with_ids: bool = True) -> DataFrame:
    """The pieces as sequences: `sequence_id` counts on over all pieces, those of a bucket in a
    row and longer ones first; `offset` is where the piece starts in its sequence, always 0."""
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    # Written before they are sorted, since a range sort reads its rows twice.
    found = settle(pieces_of(docs, Path(path).read_text(encoding="utf-8"), longest, end, with_ids),
                   "pieces")
    # Pieces of one length are put in the order of their checksums, which spreads them evenly;
    # copies of a piece that stay together only make a task of the sort larger.
    numbered = number_rows(found.withColumn("_bucket", -F.col("bucket")), [],
                           ["_bucket", "ids_crc32", "doc_id", "start"], "sequence_id", "_all")
    return numbered.withColumn("offset", F.lit(0).cast("long")).drop("_bucket", "_all")
