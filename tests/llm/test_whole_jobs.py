"""Cases that the operators once left out."""

import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradegrain.llm import (decontaminate, language, licenses, packing, secrets, simhash,
                            toxicity)
from tradegrain.llm.words import buffers

RANDOM = np.random.default_rng(11)
LETTERS_AND_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def drawn(alphabet, n):
    return "".join(RANDOM.choice(list(alphabet), n).tolist())


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_secrets_behind_names_and_paths(spark):
    values = [drawn(LETTERS_AND_DIGITS, 40) for _ in range(6)]
    a, b, c, d, e, f = values
    long = drawn(LETTERS_AND_DIGITS + "+/", 60)
    texts = [f"GH_PAT=ghp_{a}", f"get /x?sig={b}&v=1", f"hooks/x_y/{c}", f"K={d}==", f"a/b_c={e}/d-e",
             f"com/services/some/where/under/the/long/path/{f}", f"x_y={long}=", "a=b=c " + "=" * 50]
    found = {r.doc_id: r.text for r in secrets.redact(frame(spark, texts)).collect()}
    assert all(v not in found[i] for i, v in enumerate([*values, long]))
    assert found[1] == "get /x?sig=[secret]&v=1" and found[2].startswith("hooks/x_")
    assert found[3] == "K=[secret]" and found[6] == "x_y=[secret]" and found[7] == texts[7]
    spans = {r.doc_id: r for r in secrets.scan(frame(spark, texts)).collect()}
    assert all(spans[i].n_random == 1 for i in range(7)) and spans[7].n_random == 0


def test_copies_of_a_token_do_not_move_the_limit(spark):
    plain = "".join(f"{w}" for w in ["getCustomer", "Address", "FromOrder", "List"])
    values = [drawn(LETTERS_AND_DIGITS, 24) for _ in range(10)]
    few = frame(spark, [*values, plain])
    many = frame(spark, [*values, *[f"{plain} " * 100] * 400])
    once, often = ({r.doc_id for r in secrets.scan(f).where("n_random > 0").collect()}
                   for f in (few, many))
    assert once and {i for i in often if i < 10} == {i for i in once if i < 10}


def test_digits_and_upper_case_hex(spark):
    digits, hexes = ([drawn(a, 40) for _ in range(20)] for a in ("0123456789", "0123456789ABCDEF"))
    names = ["ABCDEFABCDEFABCDEFABCDEF", "CAFE" * 8, "FACADE" * 6, "THEQUICKBROWNFOXANDTHELAZYDOG"]
    for more in ([], names):      # with certainly non-random tokens of the encoding, and without
        rows = {r.doc_id: r for r in secrets.scan(frame(spark, [*digits, *hexes, *more])).collect()}
        assert all(rows[i].n_hex == 1 for i in range(20))
        assert sum(rows[i].n_random for i in range(20, 40)) >= 17
        assert not any(rows[i].n_random for i in range(40, len(rows)))


PLAIN = ("he is a good man and you are what they said of the old river , i saw that clown at the tree "
         "in an hour all day absolutely complete ever").split()


@pytest.fixture(scope="module")
def restorer(spark):
    lines = [" ".join(RANDOM.choice(PLAIN, 40).tolist()) + [" moron .", " idiot .", " ."][k % 3]
             for k in range(300)]
    counts = toxicity.letter_counts(frame(spark, lines))
    return toxicity.Restorer(toxicity.letter_model(counts).tolist())


@pytest.mark.parametrize("text, word", [
    ("he is a m o r o n and", "moron"), ("what a c l o w n", "clown"), ("y o u i d i o t", "idiot"),
    ("m o r o n, he", "moron"), ("you m.o.r.o.n!", "moron"), ("(m o r o n)", "moron")])
def test_spelled_words_beside_other_letters(restorer, text, word):
    assert word in toxicity._WORD.findall(restorer.text(text))


@pytest.mark.parametrize("text", [
    "absolutely-complete-m0r0n-ever", "m" + "0" * 30 + "r0n", "he.is.absolutely_a_complete.m0r0n",
    "2024-12-31-2024-12-31-m0r0n", "m" + "o" * 5000 + "r0n"])
def test_long_disguised_words(restorer, text):
    assert "moron" in toxicity._WORD.findall(restorer.text(f"you {text} there"))


def test_long_runs_of_words_are_decoded(restorer):
    decoded = toxicity._WORD.findall(restorer.text("heisanabsolutelyc0mpletem0r0nandagoodman"))
    assert "moron" in decoded
    assert len(restorer.text("x1y" * 20_000)) > 0
    assert all(len(t) <= toxicity.LONGEST_WORD for t in restorer.decoded)


def test_encoder_with_combining_marks():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, whole = packing.Encoder(open(path).read()), Tokenizer.from_file(path)
    signs = ["H\u0331asan", "J\u030c", "T\u0308", "W\u030a", "Y\u030a", "Abc", "E\u0301", "\u0301", "K",
             "\u212b", " ", " ", ", ", ". ", "\n", "\u0323", "H", "e", "\xa0", "<|", "Z\xfc"]
    for _ in range(400):
        text = "".join(RANDOM.choice(signs, RANDOM.integers(1, 12)).tolist())
        assert encoder.each(*buffers(pa.array([text])))[0].tolist() == whole.encode(
            text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("text, label", [
    ("Licensed under the Apache License, as Version 2.0", "apache-2.0"),
    ("licensed under the GNU General Public License, that is version 3 or later", "gpl-3.0"),
    ("see under the tree, under the rose. Licensed under the Apache License, version 2.0", "apache-2.0"),
])
def test_license_with_words_put_in(spark, text, label):
    row = licenses.scan(frame(spark, [text])).first()
    assert label in row["labels"].split(",") and [s.label for s in row["spans"]] == [label]


@pytest.mark.parametrize("text, label", [
    ("licensed under the gnu general public license version 3", "gpl-2.0"),
    ("licensed under cc by sa 4.0", "cc-by-4.0"), ("licensed under cc by nc sa 4.0", "cc-by-nc-4.0"),
    ("licensed under the apache license version 1 0", "apache-2.0")])
def test_license_of_a_sibling(spark, text, label):
    assert label not in licenses.scan(frame(spark, [text])).first()["labels"].split(",")


BODIES = {
    "isc": """# Permission to use, copy, modify, and/or distribute this software for any purpose
# with or without fee is hereby granted, provided that the above copyright notice and this
# permission notice appear in all copies.""",
    "apache-2.0": """2. Grant of Copyright License. Subject to the terms and conditions of this
License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge,
royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly
display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source
or Object form.""",
    "bsd-3": """Neither the name of Blue River Mills nor the names of its contributors may be used
to endorse or promote products derived from this software without specific prior written
permission.""",
    "gpl-3.0": """under the terms of the GNU General Public License as published by the Free
Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no
event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions""",
}


def diagonal_labels(text):
    """Labels of the passages of a text, by the definition, in plain Python."""
    words, found = re.findall(r"[a-z0-9]+", text.lower()), set()
    for passage, label in licenses.PASSAGES.items():
        own, k = passage.split(), licenses.RUN
        places = {}
        for i in range(len(own) - k + 1):
            places.setdefault(tuple(own[i:i + k]), []).append(i)
        votes = {}
        for p in range(len(words) - k + 1):
            for i in places.get(tuple(words[p:p + k]), []):
                votes.setdefault(p - i, []).append((p, i))
        for d in votes:
            near = [v for e in range(d, d + licenses.RUN_DRIFT + 1) for v in votes.get(e, [])]
            share = len({i for _, i in near}) / (len(own) - k + 1)
            length = max(p for p, _ in near) + k - min(p for p, _ in near)
            if share >= licenses.RUN_SHARE and length <= licenses.STRETCH * len(own):
                found.add(label)
    return found


@pytest.mark.parametrize("label", list(BODIES))
def test_license_bodies(spark, label):
    body = BODIES[label]
    half = body[:len(body) // 2]
    found = licenses.scan(frame(spark, [f"int x;\n{body}\nint y;", f"{half} of the river"]))
    got = {r.doc_id: r for r in found.collect()}
    assert label in got[0].labels.split(",") and label in {s.label for s in got[0].spans}
    assert label not in got[1].labels.split(",")


def test_passages_equal_plain_votes(spark):
    texts = []
    for n, passage in enumerate(list(licenses.PASSAGES) * 3):
        words = passage.split()
        for _ in range(n % 7):                     # words changed, put in and left out
            at = int(RANDOM.integers(0, len(words)))
            words[at:at + 1] = [["other"], [words[at], "more"], []][RANDOM.integers(0, 3)]
        texts.append(" ".join(RANDOM.choice(PLAIN, 5).tolist() + words + words[:n % 9]))
    texts += ["", None, " ".join(" ".join(p.split()[::-1]) for p in licenses.PASSAGES),
              " ".join(licenses.PASSAGES)]
    found = {r.doc_id: set(filter(None, r.labels.split(",")))
             for r in licenses.scan(frame(spark, texts), {}, {}).collect()}
    assert found == {i: diagonal_labels(t or "") for i, t in enumerate(texts)}
    assert 15 < sum(map(bool, found.values())) < len(texts) - 15


def test_encoder_on_random_marks():
    """Capitals before combining marks, special tokens, signs and white space in any order."""
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, whole = packing.Encoder(open(path).read()), Tokenizer.from_file(path)
    signs = list("aAbBhHéÉ .,\n\t\u030cJT\u0308W\u0301ñ'1<|>中\u0331😀ΣςA")
    texts = ["".join(RANDOM.choice(signs, RANDOM.integers(0, 60))) for _ in range(5000)]
    texts += ["a <|endoftext|> B", "H\u0331asan.", "x <|b c,", "", "." * 9, "Ab., cD. ,"]
    for repeat in range(2):
        found = encoder.each(*buffers(pa.array(texts)))
        assert [x.tolist() for x in found] == [
            e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_odd_column_names(spark):
    rows = [(i, t, 1, 2, 3) for i, t in enumerate(["", None, "A login: password = hunter2hunter2",
                                                   "some words", "some words"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int, _spans int, `x``y` int")
    labels = spark.createDataFrame([(0, 0), (2, 1)], "doc_id long, toxic int")
    items = spark.createDataFrame([(1, "no such passage")], "item_id long, text string")
    for kept, n in ((secrets.redact(docs), 5), (simhash.deduplicate(docs), 3),
                    (toxicity.remove_toxic(docs, labels), 5),
                    (decontaminate.decontaminate(docs, items), 5)):
        assert kept.columns == docs.columns and len(kept.collect()) == n
    assert "hunter2" not in "".join(r.text or "" for r in secrets.redact(docs).collect())


def test_copies_do_not_fill_the_sample_of_a_language(spark):
    rows = [("dies ist ein langer Satz", "de")] * 3000 + [(f"ein Satz {i}", "de") for i in range(40)]
    rows += [(f"the sentence number {i}", "en") for i in range(50)] + [("copia sola", "es")] * 2000
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string")
    found = language.sample(docs, F.lit(True), 20)
    n = {r["lang"]: r["count"] for r in found.groupBy("lang").count().collect()}
    assert set(n) == {"de", "en", "es"} and n["es"] == 1 and max(n.values()) <= 45
    weights = {r.text: r.weight for r in found.collect()}
    assert weights["copia sola"] == 2000
    assert weights.get("dies ist ein langer Satz", 3000) == 3000
