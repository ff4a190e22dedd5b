"""Line removal, tokenizer alignment and ranked search against direct forms."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tradegrain.llm import alignment, lines, search
from tradegrain.llm.words import LETTERS, Words, buffers

RANDOM = np.random.default_rng(5)
LOWER = {c: c + 32 for c in range(65, 91)}
COMMON = "A line that many of the documents hold"
EXTRA = ", row long, id long, n long, `a.b` string, terms string"


def frame(spark, rows, names="doc_id long, text string"):
    return spark.createDataFrame([(*r, 1, 2, 3, "d", "t") for r in rows], names + EXTRA) \
        .repartition(3)


def listed(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def key_of(line):
    return line.strip(" \t\n\v\f\r").translate(LOWER)


LINES = [
    (1, f"{COMMON}\nonce only\n  {COMMON.upper()} \t"), (2, f"x\n{COMMON}\r\n\nshort"), (3, None),
    (4, ""), (5, f"{COMMON}"), (6, f"{COMMON} "), (7, "\n\n"), (8, "é" * 19), (9, "é" * 19),
    (10, "é" * 19), (11, "É" * 20), (12, "é" * 20), (13, "é" * 20), (14, "é" * 20 + "\nend"),
    (None, "é" * 20), (15, "\n".join(f"Line of a long text {i % 500}" for i in range(40_000))),
    (16, "\n".join(f"line of a LONG text {i}" for i in range(9))), (17, "line of a long text 3"),
]
LINES += [LINES[1], LINES[4], LINES[-1], LINES[2]]


def lines_kept(rows, least_docs=3):
    held = defaultdict(list)
    for i, text in rows:
        for key in {key_of(x) for x in (text or "").split("\n")}:
            if len(key) >= 20:
                held[key].append(-(1 << 63) if i is None else i)
    out = []
    for i, text in rows:
        own = (text or "").split("\n")
        at = -(1 << 63) if i is None else i
        kept = [x for x in own if len(held[key_of(x)]) < least_docs or at == max(held[key_of(x)])]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("settings", [{}, {"shard_keys": 3}, {"broadcast_bytes": 0},
                                      {"broadcast_bytes": 0, "shard_keys": 3}])
def test_lines(spark, settings):
    docs = frame(spark, LINES)
    found = lines.remove_lines(docs, **settings)
    assert listed(found, "doc_id", "n_lines", "n_dropped", "kept_text") == lines_kept(LINES)
    assert {r.most_docs for r in found.where("n_dropped > 0").collect()} <= {3, 4, 5, 6}
    assert lines.remove_lines(docs.limit(0), **settings).collect() == []


def test_hot_shards_stand_in_copies(spark, monkeypatch):
    monkeypatch.setattr(lines, "HOT_SHARDS", 1 << 40)
    rows = [(i, f"{COMMON}\nown line of the document {i}") for i in range(400)] + LINES
    found = lines.remove_lines(frame(spark, rows), broadcast_bytes=0, shard_keys=2)
    assert listed(found, "doc_id", "n_lines", "n_dropped", "kept_text") == lines_kept(rows)


def test_perfect_hash():
    place = RANDOM.integers(0, 1 << 64, 5000, dtype=np.uint64)
    place[:3] = place[3]                      # equal places, told apart by their prints
    mark, n = RANDOM.integers(0, 1 << 64, 5000, dtype=np.uint64), np.arange(3, 5003)
    table = lines.Table.from_bytes(lines.Table.of(place, mark, n, -n).to_bytes())
    assert table.slots == 4997 and sum(map(len, table.levels)) < 5 * 5000
    known, count, last = table.find(place, mark)
    assert known.all() and (count == n).all() and (last == -n).all()
    assert not table.find(place, mark + np.uint64(1))[0].any()
    foreign = RANDOM.integers(0, 1 << 64, (2, 9999), dtype=np.uint64)
    assert not table.find(*foreign)[0].any()


def test_word_hashes():
    # Words whose letters are the Thue-Morse word and its mirror share any polynomial hash.
    one = "a"
    for _ in range(11):
        one += one.translate({97: "b", 98: "a"})
    words = [one[:2 ** k] for k in range(12)] + [one[:2 ** k].translate({97: "b", 98: "a"})
                                                  for k in range(12)]
    words += ["".join(RANDOM.choice(list("ab"), n)) + c for n in range(600) for c in "cd"]
    data = Words(*buffers(pa.array(words)), LETTERS, lower=True)
    assert len(data.starts) == len(words)
    assert len(set(data.hashes().tolist())) == len(set(words))


TOKENS = [
    (1, "The same bytes, cut in two ways."), (2, ""), (3, None), (4, "a▁b"), (5, "x  y\n\n z" + " " * 3000),
    (6, "<|endoftext|> <s> </s> <unk> hé 漢字 😀\x00 b"), (7, "word " * 3000 + "é" * 500), (8, " lead"),
    (9, "über naïve façade don't 12345 it's"), (None, "x"), (10, " 　  \t"),
]
TOKENS += [TOKENS[0], TOKENS[7]] + [
    (20 + i, "".join(RANDOM.choice(list("aeth nsé中🙂\n .'1T"), 400))) for i in range(5)]


def aligned(rows):
    a_json = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_json.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte_of = alignment._byte_of()
    documents, count = [], Counter()
    for i, text in rows:
        text = text or ""
        a, b = a_json.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
        sides = [[bytes(byte_of[c] for c in a_json.id_to_token(x)) for x in a],
                 [bytes([int(b_model.id_to_piece(x)[3:5], 16)]) if b_model.is_byte(x)
                  else b_model.id_to_piece(x).replace("▁", " ").encode() for x in b]]
        whole = (" " + text).encode()
        if not text or any(b"".join(s) != whole for s in sides):
            documents.append((i, [], [], [], []))
            continue
        of = [np.repeat(np.arange(len(s)), [len(t) for t in s]) for s in sides]
        links = sorted({(x, y) for x, y in zip(*(o.tolist() for o in of))})
        links = [(a[x], b[y]) for x, y in links]
        count.update(links)
        ends = [set(np.cumsum([len(t) for t in s]).tolist()) for s in sides]
        groups, low = [], 0
        for high in sorted(ends[0] & ends[1]):
            groups.append("|".join(",".join(str(ids[k]) for k in dict.fromkeys(
                o[low:high].tolist())) for ids, o in ((a, of[0]), (b, of[1]))))
            low = high
        documents.append((i, a, b, links, groups))
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return sorted(((i, len(a), len(b), len(g), len(k), sum(count[p] == most[p[1]] for p in k),
                    sum(count[p] for p in k),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
                   for i, a, b, k, g in documents), key=repr)


@pytest.mark.parametrize("settings", [{}, {"work": 7}, {"work": 100, "pairs": 40}])
def test_alignment(spark, settings):
    docs = frame(spark, TOKENS)
    found = alignment.align(docs, **settings)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert found.columns == names
    assert listed(found, *names) == aligned(TOKENS)
    assert alignment.align(docs.limit(0), **settings).collect() == []


def test_diagonals_cut_equal_work():
    for _ in range(50):
        size = int(RANDOM.integers(20, 400))
        a, b = (np.append(np.sort(RANDOM.choice(np.arange(1, size), RANDOM.integers(0, size - 1),
                                                replace=False)), size) for _ in range(2))
        for work in (2, 7, 50):
            edges = np.append(0, alignment.diagonals(a, b, work))
            assert edges[-1] == size and (np.diff(edges) > 0).all()
            steps = [int(np.diff(np.searchsorted(x, edges, "right")).sum()) for x in (a, b)]
            assert sum(steps) == len(a) + len(b)
            each = sum(np.diff(np.searchsorted(x, edges, "right")) for x in (a, b))
            assert each.max() <= work + 1          # a tie stays on one side


def test_stitch():
    assert alignment.stitch([("1,2|3;4|", False), ("|5,6", False), ("7|8;9|9", True)]) \
        == "1,2|3;4,7|5,6,8;9|9"
    assert alignment.stitch([("1|1", True), ("2|2", True)]) == "1|1;2|2"


def terms_of(text):
    return [w.translate(LOWER) for w in re.findall(
        r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def ranked(docs, items, k):
    own = [(i, Counter(terms_of(t))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n_docs, n_terms = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in own:
            m = 25 + (75 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in terms_of(text) if t in c)
            if score > 0:
                scores.append((-score, 1 << 63 if i is None else i))
        out += [(item, r + 1, None if i == 1 << 63 else i, -s)
                for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


WORDS = ["the", "Of", "and", "ça", "über", "cat", "dog", "tree", "River", "stone", "1st", "xyz"]
DOCUMENTS = [(i, " ".join(RANDOM.choice(WORDS, RANDOM.integers(1, 40)))) for i in range(700)]
DOCUMENTS += [(900 + i, "cat, dog; the RIVER") for i in range(40)]          # ties
DOCUMENTS += [(1000, None), (1001, ""), (1002, "!?"), (None, "cat dog"), (None, "cat dog"),
              (1003, "the " * 30_000), DOCUMENTS[0], DOCUMENTS[700]]
ITEMS = [(1, "cat dog"), (2, "cat cat ça"), (3, None), (4, "unknown"), (5, "The over and, of"),
         (1, "cat dog"), (None, "stone 1ST xyz"), (6, "")] + [
    (10 + i, " ".join(RANDOM.choice(WORDS, 6))) for i in range(25)]


@pytest.mark.parametrize("settings", [{}, {"k": 3, "item_bytes": 60}, {"k": 60}])
def test_search(spark, settings):
    docs, items = frame(spark, DOCUMENTS), frame(spark, ITEMS, "item_id long, text string")
    found = search.search(docs, items, **settings)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert listed(found, *found.columns) == ranked(DOCUMENTS, ITEMS, settings.get("k", 10))
    assert search.search(docs.limit(0), items, **settings).collect() == []
    assert search.search(docs, items.limit(0), **settings).collect() == []


def test_pruned_pairs_hold_nothing():
    """Blocks that are pruned from high bounds lose no document that reaches them."""
    topic = np.arange(50) // 10                # five topics with terms of their own
    vectors = RANDOM.integers(0, 9, (37, 50)).astype(float) * (RANDOM.random((37, 50)) < 0.8) \
        * (topic == RANDOM.integers(0, 5, (37, 1)))
    docs = RANDOM.integers(1, 9, (1000, 50)) * (RANDOM.random((1000, 50)) < 0.4) \
        * (topic == RANDOM.integers(0, 5, (1000, 1)))
    scores = docs @ vectors.T
    tree = search.ItemTree(vectors)
    first = np.concatenate([[0], np.cumsum((docs > 0).sum(1))])
    row, term = np.nonzero(docs)
    for bounds in (np.zeros(37), np.sort(scores, 0)[-10], np.sort(scores, 0)[-4]):
        best = search.Best(bounds[tree.order], 10)
        pairs = search.search_block(tree, best, np.arange(1000), first, term,
                                    docs[row, term].astype(float))
        for i, item in enumerate(tree.order):
            want = sorted((-s, d) for d, s in enumerate(scores[:, item]) if s >= bounds[item] and s > 0)
            assert list(zip((-best.scores[i]).tolist(), best.ids[i].tolist())) == want[:10]
        assert pairs < 16 * 5
