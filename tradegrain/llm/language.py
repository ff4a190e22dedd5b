"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its subwords (three neighbouring bytes within or at the
edge of words, and whole words), found by hash in a table of BUCKETS rows. A softmax over the
languages stands on that average. Both are trained together by stochastic gradient descent in
numpy, on a bounded sample: about `per_language` distinct texts of every language, by a hash.
A held-back part of the sample sets the temperature that calibrates the probabilities, and the
probability below which a prediction is `rejected` (it is reported all the same).

Prediction needs only the product of both tables, one number per subword and language.

Rows: null texts and texts without a letter are `und` with score 0, and so is every text if there is
nothing to learn from. Texts without a language are never learned from. Repeated rows are learned
from once, and one text in several languages once in each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, FloatType, IntegerType,
                               LongType, StringType, StructField, StructType)

from tradegrain.llm.frames import add_columns, arrow, in_fold
from tradegrain.llm.words import LETTERS, Words, buffers, pieces

BUCKETS_BITS = 16
WIDTH = 16               # of an embedding
PER_LANGUAGE = 1_500     # texts of a language that are learned from, about
EPOCHS, BATCH, RATE = 6, 32, 0.5
PRECISION = 0.99         # wanted among the predictions that are not rejected
UNKNOWN = "und"
_DIGITS = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_MULTIPLY = np.uint32(0x9E3779B1)


def subwords(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of a piece, and where each text's begin (one more at the end)."""
    data = np.where(LETTERS[words.data] & ~_DIGITS[words.data], words.data, 32).astype(np.uint32)
    shift = np.uint32(32 - BUCKETS_BITS)
    edge = np.concatenate(([np.uint32(32)], data, [np.uint32(32)])).astype(np.uint32)
    three = edge[:-2] | edge[1:-1] << np.uint32(8) | edge[2:] << np.uint32(16)
    keep = np.flatnonzero(data != 32)
    grams = (three[keep] * _MULTIPLY) >> shift
    whole = (words.hashes() >> np.uint64(64 - BUCKETS_BITS)).astype(np.uint32)
    # Both kinds in the order of their texts.
    a, b = np.searchsorted(keep, words.offsets), words.first
    out = np.empty(len(grams) + len(whole), np.uint32)
    out[np.arange(len(grams)) + np.repeat(b[:-1], np.diff(a))] = grams
    out[np.arange(len(whole)) + np.repeat(a[1:], np.diff(b))] = whole
    return out, a + b


def _pieces(texts: pa.Array):
    data, offsets = buffers(texts)
    for low, high in pieces(offsets):
        part = offsets[low:high + 1]
        yield low, high, Words(data[part[0]:part[-1]], part - part[0], LETTERS, lower=True)


def has_letter(text: str | None) -> bool:
    return bool(text) and (any(map(str.isalpha, text[:64])) or any(map(str.isalpha, text)))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray        # buckets x languages, divided by the temperature
    bias: np.ndarray
    least: float             # a lower probability is rejected

    def probabilities(self, buckets: np.ndarray, starts: np.ndarray) -> np.ndarray:
        n = np.diff(starts)
        some = np.flatnonzero(n)
        scores = np.zeros((len(n), len(self.languages)))
        for k in range(len(self.languages)):
            if len(some):
                scores[some, k] = np.add.reduceat(self.table[:, k][buckets], starts[some],
                                                  dtype=np.float64) / n[some]
        return softmax(scores + self.bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _counted(batches):
    """Each text as its distinct buckets and their shares."""
    for batch in batches:
        found = []
        for _, _, words in _pieces(batch.column(1)):
            buckets, starts = subwords(words)
            for a, b in zip(starts[:-1], starts[1:]):
                at, n = np.unique(buckets[a:b], return_counts=True)
                found.append((at.astype(np.int32), (n / max(1, b - a)).astype(np.float32)))
        ends = pa.array(np.cumsum([0, *(len(f[0]) for f in found)]), pa.int32())
        flat = [np.concatenate(c) for c in zip(*found)] if found else [
            np.zeros(0, np.int32), np.zeros(0, np.float32)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3),
             *(pa.ListArray.from_arrays(ends, pa.array(f)) for f in flat)],
            names=["lang", "check", "weight", "buckets", "shares"])


def sample(docs: DataFrame, learn: Column, per_language: int) -> DataFrame:
    """(lang, text, check, weight): about `per_language` distinct texts of each language, by a hash
    of the text; `weight` is how many rows have it. At least the text of the smallest hash stays,
    so that every language is learned."""
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    rows = known.select("lang", place.alias("place"),
                        F.unhex(F.md5(F.col("text").cast("binary"))).alias("key"))
    distinct = rows.groupBy("lang", "key").agg(F.count(F.lit(1)).alias("weight"),
                                               F.min("place").alias("place"))
    counts = (distinct.groupBy("lang")      # as many rows as the model has columns
              .agg(F.count(F.lit(1)).alias("texts"), F.min("place").alias("least")))
    share = F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("texts"))
    chosen = (distinct.join(F.broadcast(counts), "lang")
              .where((F.col("place") < share) | (F.col("place") == F.col("least"))))
    texts = (known.withColumn("key", F.unhex(F.md5(F.col("text").cast("binary"))))
             .join(F.broadcast(chosen.select("lang", "key", "weight")), ["lang", "key"])
             .groupBy("lang", "key").agg(F.first("text").alias("text"),
                                        F.first("weight").alias("weight")))
    return texts.select("lang", "text", (F.pmod(F.xxhash64("text", F.lit(5)), F.lit(5)) == 0)
                        .alias("check"), "weight")


def train(rows: list[tuple], seed: int = 0) -> Model | None:
    """`rows`: (language, held back, weight, buckets, shares). Texts are learned from once each; the
    weights, how many rows have a text, count where the probabilities are calibrated."""
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    number = {name: i for i, name in enumerate(languages)}
    label = np.array([number[r[0]] for r in rows])
    random = np.random.default_rng(seed)
    embed = random.normal(0, 1 / WIDTH, (1 << BUCKETS_BITS, WIDTH))
    weight, bias = np.zeros((WIDTH, len(languages))), np.zeros(len(languages))
    held = np.array([bool(r[1]) for r in rows])
    if held.all() or not held.any():
        held[:] = False
    learn = np.flatnonzero(~held)

    def mean(row) -> np.ndarray:
        return row[4] @ embed[row[3]]

    steps, step = EPOCHS * -(-len(learn) // BATCH), 0
    for _ in range(EPOCHS):
        for batch in np.array_split(random.permutation(learn), -(-len(learn) // BATCH)):
            rate, step = RATE * (1 - step / steps), step + 1
            x = np.stack([mean(rows[i]) for i in batch])
            error = softmax(x @ weight + bias)
            error[np.arange(len(batch)), label[batch]] -= 1
            back = error @ weight.T
            weight -= rate * x.T @ error
            bias -= rate * error.mean(axis=0)
            for i, g in zip(batch, back):
                embed[rows[i][3]] -= (rate * len(languages)) * np.outer(rows[i][4], g)
    table = embed @ weight
    check = np.flatnonzero(held) if held.any() else learn
    scores = np.stack([rows[i][4] @ table[rows[i][3]] for i in check]) + bias
    weights = np.array([rows[i][2] for i in check], np.float64)
    heats = np.geomspace(0.05, 20, 60)
    loss = [-(weights * np.log(softmax(scores / t)[np.arange(len(check)), label[check]] + 1e-12))
            .sum() for t in heats]
    heat = heats[int(np.argmin(loss))]
    best = softmax(scores / heat)
    right, top = best.argmax(axis=1) == label[check], best.max(axis=1)
    order = np.argsort(-top)
    good = np.cumsum((weights * right)[order]) / np.cumsum(weights[order]) >= PRECISION
    least = float(top[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return Model(languages, (table / heat).astype(np.float32), bias / heat, least)


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model of the `lang` of the rows where `learn` is true."""
    schema = StructType([StructField("lang", StringType()), StructField("check", BooleanType()),
                         StructField("weight", LongType()), StructField("buckets", ArrayType(IntegerType())),
                         StructField("shares", ArrayType(FloatType()))])
    found = arrow(sample(docs, learn, per_language).select("lang", "text", "check", "weight"), _counted,
                  schema).toArrow()
    columns = [found[n].to_pylist() for n in ("lang", "check", "weight")]
    lists = [[x.values.to_numpy(zero_copy_only=False) for x in found[n]]
             for n in ("buckets", "shares")]
    rows = sorted(zip(*columns, *lists), key=lambda r: (*r[:3], r[3].tobytes(), r[4].tobytes()))
    return train(rows)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs` with lang_pred, score (the calibrated probability) and rejected."""
    out = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                      StructField("rejected", BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)   # of fixed size per language

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        texts, known = batch.column(0), shared.value
        names, scores, rejected = [], [], []
        for low, high, words in _pieces(texts):
            best = known.probabilities(*subwords(words)) if known else None
            for i, text in enumerate(texts.slice(low, high - low).to_pylist()):
                if known is None or not has_letter(text):
                    names.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                    continue
                k = int(best[i].argmax())
                names.append(known.languages[k]), scores.append(float(min(1, best[i, k])))
                rejected.append(scores[-1] < known.least)
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                pa.array(rejected, pa.bool_())]

    return add_columns(docs, ["text"], out, compute)


def identify(docs: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected. Learned from the rows
    whose crc32 of the id leaves another remainder than `held`."""
    held_out = in_fold("doc_id", modulus, held)
    narrow = docs.select("doc_id", "text", "lang")
    model = fit(narrow, ~held_out, PER_LANGUAGE)
    return predict(narrow.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")
