"""Toxicity of texts whose words may be disguised: noisy-channel decoding, then a score.

A disguised word is one with digits or signs for letters, letters said several times, or letters
spelled out one by one. Each is read as a lattice: every sign may stand for some letters or for
nothing, a repeated letter for one. The Viterbi path through it under a character trigram model is
the restored word. Letters spelled out may be several words: paths may end a word there, and the
reading as one word is kept beside them. The character model is counted over all texts.

The score is learned from labelled rows only. In a sample of about `per_class` texts of each label,
chosen by hash, restored words and their beginnings are counted per label; those that stand in
toxic texts far more often than chance allows are the lexicon, and a logistic regression on what a
text has of it gives the probability.

Rows: null and empty texts are scored as texts without any such word. Rows that are repeated in the
labels count by their largest label. Without labels of both kinds every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tradegrain.llm.frames import add_columns, arrow, fresh, in_fold
from tradegrain.llm.words import buffers

# Letters that a sign may stand for.
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
         "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou"}
# Costs of the channel, in natural logarithms.
AS_IS, FOR_LETTER, DROPPED, REPEATED = 0.0, -0.7, -2.0, -0.7

PER_CLASS = 4_000          # labelled texts of each label that are learned from, about
LEXICON = 2_000            # entries at most
BEGINNINGS = (4, 5, 6)     # characters of a word's beginning that are entries of their own
TOXIC = 0.3
LONGEST_WORD = 24          # longer signs-and-letters words may be several, and are not remembered
_REMEMBERED = 100_000      # words whose entries a task remembers

_SYMBOLS = 28              # word edge, a to z, any other letter
_WORD = re.compile(r"[^\W\d_]+")
_SPELLED = re.compile(r"""(?<![^\s("'\[])[^\W_](?:[ .\-_*][^\W_]){2,}(?=[.,;:!?"')\]]*(?!\S))""")
_TOKEN = re.compile(r"\S+")
_INNER_SIGN = re.compile(r"[^\W\d_][0-9@$!|+(.*_\-]+[^\W\d_]|[0-9@$!|+(][^\W\d_]{2}"
                         r"|[^\W\d_]{2}[0-9@$]$")
_THRICE = re.compile(r"([^\W\d_])\1\1")
_LONG_RUN = re.compile(r"(.)\1{3,}")
_TWICE = re.compile(r"([^\W\d_])\1+")
_EDGE = "\"'.,;:?!%&#*()[]{}<>=/\\-_~`"


def _symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


def letter_counts(docs: DataFrame) -> np.ndarray:
    """How often three symbols follow each other, over all texts."""
    size = _SYMBOLS ** 3
    lookup = np.zeros(256, np.uint8)
    lookup[97:123], lookup[65:91], lookup[128:] = range(1, 27), range(1, 27), 27

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            # Continuation bytes are left out, so that a letter is one symbol; a text's end is not
            # marked: texts are long, and most end with a sign.
            symbols = lookup[data[(data & 0xC0) != 0x80]]
            for at in range(0, len(symbols) - 2, 1 << 20):
                s = symbols[at:at + (1 << 20) + 2].astype(np.int64)
                total += np.bincount((s[:-2] * _SYMBOLS + s[1:-1]) * _SYMBOLS + s[2:],
                                     minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])],
                                         names=["gram", "n"])

    rows = (arrow(docs.select("text"), run, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(size)
    for gram, n in rows:                     # at most 28 * 28 * 28
        counts[gram] = n
    return counts.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)


def letter_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a symbol after two others, smoothed by shorter contexts."""
    one = counts.sum((0, 1)) + 0.5
    one /= one.sum()
    two = counts.sum(0)
    two = (two + 5 * one) / (two.sum(1, keepdims=True) + 5)
    return np.log((counts + 5 * two) / (counts.sum(2, keepdims=True) + 5))


def viterbi(token: str, model: list, several: bool = False) -> str:
    """The likeliest word that `token` (lower case) may stand for, or `several`, with spaces."""
    paths = {(0, 0): (0.0, None)}       # a path's letters as a chain, the last one first
    before = ""
    for c in token:
        ways = [(s, FOR_LETTER) for s in SIGNS.get(c, "")]
        if c.isalpha():
            ways = [(c, AS_IS)] + ([("", REPEATED)] if c == before else [])
        elif c == before:
            ways = [("", REPEATED), *ways]
        else:
            ways.append(("", DROPPED))
        if several:
            for (a, b), (cost, word) in list(paths.items()):
                total = cost + model[a][b][0]
                if b and ((b, 0) not in paths or total > paths[b, 0][0]):
                    paths[b, 0] = (total, (word, " "))
        following = {}
        for (a, b), (cost, word) in paths.items():
            for letter, price in ways:
                if letter:
                    s = _symbol(letter)
                    state, total = (b, s), cost + price + model[a][b][s]
                else:
                    state, total = (a, b), cost + price
                if state not in following or total > following[state][0]:
                    following[state] = (total, (word, letter) if letter else word)
        paths, before = following, c
    # A path that ended its last word is over; the others end it now.
    word = max(((cost + (model[a][b][0] if b or not a else 0.0), word)
                for (a, b), (cost, word) in paths.items()), key=lambda p: p[0])[1]
    letters = []
    while word:
        word, letter = word
        letters.append(letter)
    return "".join(reversed(letters)).strip()


def squeezed(word: str) -> str:
    return _TWICE.sub(r"\1", word)


@dataclass
class Restorer:
    """Restores the disguised words of texts, remembering those it has decoded."""

    model: list
    decoded: dict[str, str] = field(default_factory=dict)

    def _decode(self, token: str) -> str:
        if len(token) > LONGEST_WORD:
            return viterbi(token, self.model)
        if token not in self.decoded:
            if len(self.decoded) >= _REMEMBERED:
                self.decoded.clear()
            self.decoded[token] = viterbi(token, self.model)
        return self.decoded[token]

    def _several(self, token: str) -> str:
        """The words that `token` may stand for, and the one word, if that is another reading."""
        words, word = viterbi(token, self.model, several=True), self._decode(token)
        return words if words == word else f"{words} {word}"

    def token(self, token: str) -> str:
        # A run of one sign at an end is decoration, unless it may stand for a letter in it.
        bare = token.strip(_EDGE)
        if len(bare) > 3 and bare[-3:] in ("$$$", "+++", "|||"):
            bare = bare.rstrip("$+|")
        if len(bare) > LONGEST_WORD:
            bare = _LONG_RUN.sub(r"\1\1\1", bare)
        if not bare or bare.isalpha() and not _THRICE.search(bare):
            return token
        if not (_INNER_SIGN.search(bare) or _THRICE.search(bare)):
            return token
        letters = sum(map(str.isalpha, bare))
        if letters == 0:
            return token
        # Hyphens and dots part whole words as a rule; only single letters are spelled out.
        parts = re.split(r"[.\-_]+", bare)
        if len(parts) > 1 and max(map(len, parts)) > 1:
            return " ".join(self.token(p) for p in parts if p)
        if 3 * sum(map(str.isdigit, bare)) > 2 * len(bare):
            return token
        if len(bare) > LONGEST_WORD:
            return self._several(bare)
        return self._decode(bare)

    def text(self, text: str | None) -> str:
        text = (text or "").lower()
        text = _SPELLED.sub(lambda m: " " + self._several(m[0].replace(" ", "")) + " ", text)
        noisy = [m for m in _TOKEN.finditer(text)
                 if not (t := m[0]).isalpha() and _INNER_SIGN.search(t) or _THRICE.search(t)] \
            if _ANY_NOISE.search(text) else []
        if not noisy:
            return text
        out, at = [], 0
        for m in noisy:
            out += [text[at:m.start()], self.token(m[0])]
            at = m.end()
        return "".join([*out, text[at:]])


_ANY_NOISE = re.compile(_INNER_SIGN.pattern + r"|([^\W\d_])\1\1")


def entries(word: str) -> list[str]:
    """What a word is counted as: itself, and its beginnings (marked by a hyphen)."""
    return [word, *(f"{word[:n]}-" for n in BEGINNINGS if len(word) > n)]


def sample(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int) -> DataFrame:
    """(text, toxic) of about `per_class` rows of each label, by hash."""
    marks = (labels.where("doc_id is not null and toxic is not null")
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    known = marks.where(learn)
    counts = known.groupBy("toxic").count()
    share = F.least(F.lit(1.0), F.lit(float(per_class)) / F.col("count"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = (known.where("toxic in (0, 1)").join(F.broadcast(counts), "toxic")
              .where(place < share).select("doc_id", "toxic"))
    # Two rows of counts; and a sample of fixed size.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


@dataclass
class Model:
    letters: list
    weights: dict[str, float]
    regression: np.ndarray | None
    squeezed: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        for word, weight in self.weights.items():
            short = squeezed(word)
            self.squeezed[short] = max(weight, self.squeezed.get(short, weight))
        self.seen: dict[str, float] = {}

    def word(self, word: str) -> float:
        """The largest weight among a word's entries; 0 if it has none."""
        found = self.seen.get(word)
        if found is None:
            found = max((self.weights.get(e, 0.0) for e in entries(word)), default=0.0)
            if not found and (short := squeezed(word)) != word:
                found = self.squeezed.get(short, 0.0)     # a letter said twice
            if len(self.seen) >= _REMEMBERED:
                self.seen.clear()
            self.seen[word] = found
        return found

    def features(self, restored: str) -> tuple[float, float, float]:
        found = [w for w in map(self.word, set(_WORD.findall(restored))) if w]
        return (1.0, min(len(found), 5), max(found, default=0.0))

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.regression is None:
            return np.zeros(len(features))
        return 1 / (1 + np.exp(-np.clip(features @ self.regression, -30, 30)))


def lexicon(rows: DataFrame, letters: list) -> dict[str, float]:
    """Entries that toxic texts have far more often than others, with their log odds."""
    def run(batches):
        restorer = Restorer(letters)
        for batch in batches:
            counts = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(_WORD.findall(restorer.text(text)))
                counts[toxic].update({e for w in words for e in entries(w)})
            names = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64())
                                                 for c in counts)], names=["entry", "mild", "toxic"])

    schema = StructType([StructField("entry", StringType()), StructField("mild", LongType()),
                         StructField("toxic", LongType())])
    sizes = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return {}
    counted = (arrow(rows.select("text", "toxic"), run, schema).groupBy("entry")
               .agg(F.sum("mild").alias("mild"), F.sum("toxic").alias("toxic")).where("toxic >= 3"))
    # Binomial tail bound: with chance `q` of the toxic class, n times the divergence of the
    # observed share must exceed the logarithm of the number of entries that are tried.
    q = sizes[1] / (sizes[0] + sizes[1])
    n, p = F.col("toxic") + F.col("mild"), F.col("toxic") / (F.col("toxic") + F.col("mild"))
    gain = n * (p * F.log(p / q) + F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - q))).otherwise(0.0))
    odds = (F.log((F.col("toxic") + 0.5) / (sizes[1] + 1))
            - F.log((F.col("mild") + 0.5) / (sizes[0] + 1)))
    tried = max(1, counted.count())
    best = (counted.where((p > q) & (gain > math.log(tried) + 1) & (odds > 2))
            .select("entry", odds.alias("odds"), gain.alias("gain"))
            .orderBy(F.desc("gain"), "entry").limit(LEXICON).collect())
    return {r["entry"]: r["odds"] for r in best}


def regression(x: np.ndarray, y: np.ndarray, n: np.ndarray, prior: float) -> np.ndarray:
    """Logistic regression by Newton's method; each row counts `n` times, weighted to the `prior`
    of label 1."""
    toxic = (n * y).sum() / n.sum()
    weight = n * np.where(y == 1, prior / max(toxic, 1e-9), (1 - prior) / max(1 - toxic, 1e-9))
    beta, penalty = np.zeros(x.shape[1]), np.diag([0.0, 0.01, 0.01]) * n.sum() * 0.01
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty @ beta
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty
        beta -= np.linalg.solve(curve + 1e-9 * np.eye(len(beta)), slope)
    return beta


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = PER_CLASS) -> Model:
    """A model of `toxic` in the labels of the rows where `learn`, a condition on doc_id, holds."""
    letters = letter_model(letter_counts(docs)).tolist()
    rows = sample(docs, labels, learn, per_class)
    model = Model(letters, lexicon(rows, letters), None)
    if not model.weights:
        return model

    def run(batches):
        restorer = Restorer(letters)
        for batch in batches:
            x = [model.features(restorer.text(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([v[k] for v in x], pa.float64()) for k in range(3)),
                 batch.column(1).cast(pa.float64())], names=list("abcy"))

    # At most six numbers of entries times LEXICON weights times two labels.
    table = np.array([c.to_numpy() for c in arrow(rows, run, "a double, b double, c double, y double")
                      .groupBy("a", "b", "c", "y").count().toArrow().columns])
    known = labels.where(learn).agg(F.avg("toxic")).first()[0]
    model.regression = regression(table[:3].T, table[3], table[4], min(max(known, 0.01), 0.99))
    return model


def add_score(docs: DataFrame, model: Model, name: str, restored: str | None = None) -> DataFrame:
    """`docs` with the score of each text and, if named, the restored text."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.letters, model.weights, model.regression))     # of fixed size
    out = StructType([StructField(name, DoubleType()),
                      *([StructField(restored, StringType())] if restored else [])])

    state: dict = {}

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        if not state:
            state["model"] = Model(*shared.value)
            state["restorer"] = Restorer(shared.value[0])
        known, restorer = state["model"], state["restorer"]
        texts = [restorer.text(t) for t in batch.column(0).to_pylist()]
        x = np.array([known.features(t) for t in texts]).reshape(-1, 3)
        return [pa.array(known.score(x), pa.float64()),
                *([pa.array(texts, pa.string())] if restored else [])]

    return add_columns(docs, ["text"], out, compute)


def score(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Learned from the labels of the
    rows whose crc32 of the id leaves another remainder than `held`."""
    held_out = in_fold("doc_id", modulus, held)
    model = fit(docs, labels, ~held_out)
    scored = add_score(docs.select("doc_id", "text"), model, "score")
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, labels: DataFrame, least: float = TOXIC) -> DataFrame:
    """`docs` without those that score `least` or more; all columns as they were."""
    name = fresh(docs, "toxicity")
    model = fit(docs, labels, ~in_fold("doc_id", 4, 2))
    return add_score(docs, model, name).where(F.col(name) < least).drop(name)
