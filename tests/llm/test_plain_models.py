"""Models against plain Python: all paths of a lattice, a forward pass, the rounds of EM."""

import itertools
import math
import re

import numpy as np
import pyarrow as pa
import pytest

from tradegrain.llm import interpolation, language, toxicity
from tradegrain.llm.words import LETTERS, Words, buffers

RANDOM = np.random.default_rng(7)


def all_paths(token, model, several):
    """(cost, text) of every path through the token's lattice."""
    choices, before = [], ""
    for c in token:
        ways = [(s, toxicity.FOR_LETTER) for s in toxicity.SIGNS.get(c, "")]
        if c.isalpha():
            ways.append((c, toxicity.AS_IS))
        if c == before:
            ways.append(("", toxicity.REPEATED))
        elif not c.isalpha():
            ways.append(("", toxicity.DROPPED))
        choices.append(ways)
        before = c
    edges = [(False, True) if several else (False,)] * len(token)
    for path in itertools.product(*choices):
        for cut in itertools.product(*edges):
            a, b, cost, text = 0, 0, 0.0, ""
            for (letter, price), edge in zip(path, cut):
                if edge:
                    if not b:
                        break
                    a, b, cost, text = b, 0, cost + model[a][b][0], text + " "
                cost += price
                if letter:
                    s = toxicity._symbol(letter)
                    a, b, cost, text = b, s, cost + model[a][b][s], text + letter
            else:
                yield cost + (model[a][b][0] if b or not a else 0.0), text.strip()


@pytest.mark.parametrize("several", [False, True])
def test_viterbi_finds_the_best_of_all_paths(several):
    model = toxicity.letter_model(RANDOM.integers(0, 30, (28, 28, 28)).astype(float)).tolist()
    signs = list("abmor" + "é" + "".join(toxicity.SIGNS)[:8] + ".-")
    for _ in range(60):
        token = "".join(RANDOM.choice(signs, RANDOM.integers(1, 6)))
        if RANDOM.random() < 0.4:
            token = token[:2] + token[1:]                      # a sign twice
        best = {}
        for cost, text in all_paths(token, model, several):
            best[text] = max(cost, best.get(text, -math.inf))
        found = toxicity.viterbi(token, model, several)
        assert math.isclose(best[found], max(best.values()), abs_tol=1e-9), token


def test_language_probabilities_by_hand():
    size = 1 << language.BUCKETS_BITS
    model = language.Model(["aa", "bb", "cc"], RANDOM.normal(0, 1, (size, 3)).astype(np.float32),
                           np.array([0.1, -0.2, 0.3]), 0.0)
    texts = ["Das ist ein Haus.", "", "él  año 2024", None, "x", "12 34", "word " * 300]
    for low, high, words in language._pieces(pa.array(texts)):
        found = model.probabilities(*language.subwords(words))
        for text, got in zip(texts[low:high], found):
            data = (text or "").encode().lower()
            kept = bytes(c if LETTERS[c] and not 48 <= c <= 57 else 32 for c in data)
            grams = [kept[i - 1:i + 2] if i else b" " + kept[:2] for i in range(len(kept))
                     if kept[i] != 32]
            rows = [(int.from_bytes(g.ljust(3), "little") * 0x9E3779B1 % (1 << 32))
                    >> (32 - language.BUCKETS_BITS) for g in grams]
            for word in re.findall(rb"[0-9a-z\x80-\xff]+", data):
                own = Words(*buffers(pa.array([word], pa.binary())), LETTERS, lower=True)
                rows.append(int(own.hashes()[0]) >> (64 - language.BUCKETS_BITS))
            sums = [sum(float(model.table[r, k]) for r in rows) / max(1, len(rows))
                    + model.bias[k] for k in range(3)]
            total = sum(math.exp(s) for s in sums)
            assert np.allclose(got, [math.exp(s) / total for s in sums], atol=1e-9), text


def test_mixture_weights_by_plain_rounds():
    rows = [(b, int(step), int(n)) for b in (1, 3, 4) for step, n in zip(
        RANDOM.integers(-400, 900, 12), RANDOM.integers(1, 50, 12))] + [(3, -1 << 30, 25)]
    found = interpolation.weights(rows)
    for b in (1, 3, 4):
        weight = 0.5
        for _ in range(interpolation.ROUNDS):
            gained = total = 0.0
            for bucket, step, n in rows:
                if bucket == b:
                    ratio = 0.0 if step == -1 << 30 else 10 ** (step / interpolation.BINS)
                    gained += n * weight * ratio / (weight * ratio + 1 - weight)
                    total += n
            weight = min(gained / total, 1 - 1e-6)
        assert math.isclose(found[b], weight, rel_tol=1e-9)
    assert set(found) == {1, 3, 4}
