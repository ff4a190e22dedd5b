"""License notices and texts by diagonal voting.

Every rolling word pair of every text, and every rolling run of five words, is joined by its hash to
the places of such runs in a fixed list of templates: pairs for phrases and single sentences, five
words for passages of license texts, whose pairs are those of any prose. A hit votes for its
diagonal, the difference of the two places; each diagonal is merged with the next ones (words put in
or left out move a notice to another), and a merged span counts if enough of its template stands
within a stretch of about the template's length: of a sentence nearly all pairs, or all words and
all but a few pairs, those that words put in part; of a passage, in which names change, most runs.
Short phrases count only whole. A hit is verified by its words, so equal hashes of other words do
not vote.

The templates are a fixed list, and broadcast. Texts stay in place; what is shuffled is the hits.

Rows: a null text has no words. Repeated rows and rows without an id are reported one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tradegrain.llm.frames import arrow
from tradegrain.llm.words import LETTERS, Words, buffers, each_piece, mix, same_text

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Sentences that common licenses are known by, and labels of our own.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "gnu general public license as published by the free software foundation either version 2 of the "
    "license": "gpl-2.0",
    "gnu general public license as published by the free software foundation either version 3 of the "
    "license": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "released under the mit license": "mit-grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files": "mit-grant",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
# Passages of license texts without the blanks for names, each found by itself, and
# labels of our own.
PASSAGES = {
    "permission to use copy modify and or distribute this software for any purpose with or without "
    "fee is hereby granted provided that the above copyright notice and this permission notice "
    "appear in all copies": "isc",
    "the software is provided as is and the author disclaims all warranties with regard to this "
    "software including all implied warranties of merchantability and fitness in no event shall "
    "the author be liable for any special direct indirect or consequential damages or any damages "
    "whatsoever resulting from loss of use data or profits": "isc",
    "to deal in the software without restriction including without limitation the rights to use "
    "copy modify merge publish distribute sublicense and or sell copies of the software and to "
    "permit persons to whom the software is furnished to do so": "mit-grant",
    "the software is provided as is without warranty of any kind express or implied including but "
    "not limited to the warranties of merchantability fitness for a particular purpose and "
    "noninfringement in no event shall the authors or copyright holders be liable for any claim "
    "damages or other liability": "mit-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions "
    "and the following disclaimer": "bsd",
    "redistributions in binary form must reproduce the above copyright notice this list of "
    "conditions and the following disclaimer in the documentation and or other materials provided "
    "with the distribution": "bsd",
    "nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission": "bsd-3",
    "this software is provided as is without any express or implied warranty in no event will the "
    "authors be held liable for any damages arising from the use of this software permission is "
    "granted to anyone to use this software for any purpose including commercial applications and "
    "to alter it and redistribute it freely": "zlib",
    "anyone is free to copy modify publish use compile sell or distribute this software either in "
    "source code form or as a compiled binary for any purpose commercial or non commercial and by "
    "any means": "unlicense",
    "unless required by applicable law or agreed to in writing software distributed under the "
    "license is distributed on an as is basis without warranties or conditions of any kind either "
    "express or implied": "apache-2.0",
    "subject to the terms and conditions of this license each contributor hereby grants to you a "
    "perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to "
    "reproduce prepare derivative works of publicly display publicly perform sublicense and "
    "distribute the work and such derivative works in source or object form": "apache-2.0",
    "subject to the terms and conditions of this license each contributor hereby grants to you a "
    "perpetual worldwide non exclusive no charge royalty free irrevocable except as stated in this "
    "section patent license to make have made use offer to sell sell import and otherwise transfer "
    "the work": "apache-2.0",
    "you must cause any modified files to carry prominent notices stating that you changed the "
    "files and you must retain in the source form of any derivative works that you distribute all "
    "copyright patent trademark and attribution notices from the source form of the work":
        "apache-2.0",
    "the licenses for most software are designed to take away your freedom to share and change it "
    "by contrast the gnu general public license is intended to guarantee your freedom to share and "
    "change free software to make sure the software is free for all its users": "gpl-2.0",
    "the licenses for most software and other practical works are designed to take away your "
    "freedom to share and change the works by contrast the gnu general public license is intended "
    "to guarantee your freedom to share and change all versions of a program to make sure it "
    "remains free software for all its users": "gpl-3.0",
    "covered software is provided under this license on an as is basis without warranty of any kind "
    "either expressed implied or statutory including without limitation warranties that the covered "
    "software is free of defects merchantable fit for a particular purpose or non infringing":
        "mpl-2.0",
}
GRAM = 2          # words
RUN = 5           # words, for passages
RUN_DRIFT = 8     # diagonals of passages this close are merged
RUN_SHARE = 0.75  # of a passage's runs that must be found
DRIFT = 3         # diagonals this close are merged
SHARE = 0.9       # of a notice's word pairs that must be found; or all its words, in so many pairs:
LOST, LEAST = 2, 7   # pairs that words put in may part, in notices of at least so many pairs; the
                  # shorter ones tell their siblings by single words
STRETCH = 1.5     # a span is at most this many times as long as its notice
PHRASE_SCORE = 0.5
_TEXT = -1        # template number of the row that every text has, with its number of words


def _grams(words: Words, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words."""
    one = words.hashes()
    if len(one) < size:
        return np.zeros(0, np.int64)
    last = len(one) - size + 1
    run = one[:last]
    for k in range(1, size):
        run = mix(run, one[k:last + k])
    return run.view(np.int64)


def template_rows(texts: list[str], size: int, first: int = 0) -> list[tuple[int, int, int, str]]:
    """(hash, template, place, the words) of every run of words of the templates, which are numbered
    from `first`."""
    rows = []
    for number, text in enumerate(texts, first):
        words = Words(*buffers(pa.array([text])), LETTERS, lower=True)
        own = text.split()
        rows += [(h, number, i, " ".join(own[i:i + size]))
                 for i, h in enumerate(_grams(words, size).tolist())]
    return rows


def _rolling(hashes: dict[int, np.ndarray], marker: int):
    """A row for each run of words of each size (its words only where they may be a template's), and
    one for each text that gives its number of words as the place."""
    names = ["row", "doc_id", "place", "hash", "words"]

    def run(batches):
        for batch in batches:
            for low, high, words in each_piece(batch.column(2), LETTERS, lower=True):
                yield rows(batch, pa.array(np.arange(low, high)), words.lengths(),
                           np.full(high - low, marker), np.full(high - low, None, object))
                for size, known in hashes.items():
                    grams = _grams(words, size)
                    at = np.flatnonzero(same_text(words.first, size)[:len(grams)])
                    text = np.searchsorted(words.first, at, "right") - 1
                    grams = grams[at]
                    shown = np.full(len(at), None, object)
                    for k in np.flatnonzero(np.isin(grams, known)).tolist():
                        shown[k] = b" ".join(words.word(at[k] + j) for j in range(size)).decode()
                    yield rows(batch, pa.array(text + low), at - words.first[text], grams, shown)

    def rows(batch, owner, place, hash_, shown):
        return pa.RecordBatch.from_arrays([
            batch.column(0).take(owner), batch.column(1).take(owner), pa.array(place),
            pa.array(hash_), pa.array(shown, pa.string())], names=names)
    return run


def scan(docs: DataFrame, phrases: dict[str, str] | None = None,
         notices: dict[str, str] | None = None,
         passages: dict[str, str] | None = None) -> DataFrame:
    """One row per text: doc_id, n_words, the places of whole phrases (n_base, first_word,
    last_word, base_labels), all labels, a score from 0 to 1, and the spans of notices and
    passages."""
    phrases = PHRASES if phrases is None else phrases
    notices = NOTICES if notices is None else notices
    passages = PASSAGES if passages is None else passages
    short, labels = [*phrases, *notices], [*phrases.values(), *notices.values(), *passages.values()]
    if any(len(t.split()) < GRAM for t in short) or any(len(t.split()) < RUN for t in passages):
        raise ValueError(f"a template needs {GRAM} words, a passage {RUN}")
    spark = docs.sparkSession
    pairs, runs = template_rows(short, GRAM), template_rows(list(passages), RUN, len(short))
    grams = pairs + runs
    marker = 0
    while marker in {g[0] for g in grams}:
        marker += 1
    sizes = {n: sum(g[1] == n for g in grams) for n in range(len(labels))}
    table = spark.createDataFrame(
        [(h, n, i, w, labels[n], n < len(phrases), n >= len(short), sizes[n])
         for h, n, i, w in grams] + [(marker, _TEXT, 0, None, None, False, False, 1)],
        "hash long, template int, at long, gram string, label string, phrase boolean,"
        " passage boolean, grams int")
    schema = StructType([StructField("row", LongType()), docs.schema["doc_id"],
                         StructField("place", LongType()), StructField("hash", LongType()),
                         StructField("words", StringType())])
    rolled = arrow(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"),
                   _rolling({size: np.array([g[0] for g in rows], np.int64)
                              for size, rows in ((GRAM, pairs), (RUN, runs)) if rows}, marker),
                   schema)
    hits = (rolled.join(F.broadcast(table), "hash")
            .where((F.col("template") == _TEXT) | (F.col("words") == F.col("gram"))))

    of_text = ["row", "doc_id", "template", "label", "phrase", "passage", "grams"]
    votes = (hits.groupBy(*of_text, (F.col("place") - F.col("at")).alias("diagonal"))
             .agg(F.count(F.lit(1)).alias("votes"), F.min("place").alias("low"),
                  F.max("place").alias("high"), F.collect_set("at").alias("ats"))
             .where(~F.col("phrase") | (F.col("votes") == F.col("grams"))))
    # Every diagonal of a notice with those up to DRIFT after it: no run of strays makes it longer.
    order = Window.partitionBy(*of_text).orderBy("diagonal")
    near, wide = order.rangeBetween(0, DRIFT), order.rangeBetween(0, RUN_DRIFT)
    passage = F.col("passage")
    size = F.when(passage, RUN).otherwise(GRAM)
    whole = F.col("phrase") | (F.col("template") == _TEXT)

    def over(alone, value):
        return (F.when(whole, alone).when(passage, value.over(wide))
                .otherwise(value.over(near)))

    merged = (votes.withColumn("found", over(F.lit(None), F.collect_list("ats")))
              .withColumn("found", F.array_distinct(F.flatten("found")))
              .select(*of_text, "diagonal", "found",
                      over(F.col("low"), F.min("low")).alias("low"),
                      (over(F.col("high"), F.max("high")) + size).alias("high")))
    n = F.size("found")
    share = n / F.col("grams")
    # Lost pairs whose neighbours are found: no word of the notice is missing.
    covered = F.forall(F.sequence(F.lit(0), F.col("grams")), lambda w: F.array_contains("found", w)
                       | F.array_contains("found", w - 1))
    enough = F.when(passage, share >= RUN_SHARE).otherwise(
        (share >= SHARE) | (F.col("grams") >= LEAST) & (n >= F.col("grams") - LOST) & covered)
    verified = enough & (F.col("high") - F.col("low") <= STRETCH * (F.col("grams") + size - 1))
    is_text, phrase = F.col("template") == _TEXT, F.col("phrase")
    merged = merged.withColumn("notice", F.coalesce(~is_text & ~phrase & verified, F.lit(False)))
    # Diagonals before a notice's own reach it as well: of spans with one end the fullest counts,
    # and of these the shortest.
    rank = F.when(F.col("notice"), F.struct(F.size("found"), "low"))
    best = F.max(rank).over(Window.partitionBy(*of_text, "high"))
    merged = merged.withColumn("notice", F.coalesce(rank == best, F.lit(False)))
    notice = F.col("notice")

    def joined(wanted):
        return F.array_join(F.array_sort(F.collect_set(F.when(wanted, F.col("label")))), ",")

    span = F.struct("low", "high", "label")
    return merged.groupBy("row", "doc_id").agg(
        F.max(F.when(is_text, F.col("diagonal"))).alias("n_words"),
        F.count_if(phrase).alias("n_base"),
        F.min(F.when(phrase, F.col("diagonal"))).alias("first_word"),
        F.max(F.when(phrase, F.col("diagonal"))).alias("last_word"),
        joined(phrase).alias("base_labels"), joined(phrase | notice).alias("labels"),
        F.coalesce(F.max(F.when(phrase, F.lit(PHRASE_SCORE)).when(notice, share)),
                   F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(notice, span))).alias("spans")).drop("row")
