"""Secrets in texts: three known forms, and tokens that look random; DataFrame functions only.

Long tokens go through a battery of tests within the alphabet of their inferred encoding: a
chi-squared test of uniform symbols, a runs test about the alphabet's middle, and lag-one serial
correlation. A token looks random if the battery does not reject uniformity, and if prose of its
length would hardly be that uniform. For the latter the chance of so small a chi-squared under the
letter frequencies of the corpus's own words is a p-value, and a false-discovery rate of FALSE is
held within every encoding and class of lengths (Benjamini and Hochberg over distinct tokens, on a
histogram of the p-values, which rounds them up).

Upper-case hexadecimal digits repeat in prose about as often as by chance. Their p-value is the
chance that a word or name of that length has no other symbol, by the symbols of the corpus's wider
tokens; and, where over FALSE of their tokens are certainly not random, at least the chance of so
small a likelihood under the neighbouring symbols of these.

Matches are found by splitting a text, so that their places come from the lengths of what lies
before; the running sums are windows over the matches of one text and kind.

Rows: a null text is empty. Repeated rows and rows without an id are reported one by one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradegrain.llm.frames import fresh, quoted
from tradegrain.session import settle

# The forms, in the order in which spans that start together are listed. Matches
# fail if the given group is shorter.
FORMS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
               r"""([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),       # a shorter run of these characters fails anyway
)
RANDOM = "random"
# Candidates, of 20 characters or more with their padding: whole runs without an inner '=', and
# what lies between the signs in which encodings differ, so that a name or a path before a value
# neither keeps it from fitting an encoding nor hides it. No two patterns give the same place.
_PADDING = r"(?:=++(?![A-Za-z0-9+/_-]))?"
TOKENS = tuple(pattern + _PADDING for pattern in (
    r"[A-Za-z0-9+/_-]{18,}+",
    r"(?:(?<=[+/_-])|(?<![A-Za-z0-9])(?=[A-Za-z0-9]++[+/_-]))[A-Za-z0-9]{18,}+",
    r"(?:(?<=[_-])|(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/]++[_-]))"
    r"(?=[A-Za-z0-9]*+[+/])[A-Za-z0-9+/]{18,}+",
    r"(?:(?<=[+/])|(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9_-]++[+/]))"
    r"(?=[A-Za-z0-9]*+[_-])[A-Za-z0-9_-]{18,}+",
))
LETTERS_AND_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
# Encodings by the first pattern that fits, and their alphabets.
ENCODINGS = (
    ("decimal", r"^[0-9]+$", "0123456789"),
    ("hex", r"^[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", r"^[0-9A-F]+$", "0123456789ABCDEF"),
    ("letters", r"^[a-z]+$|^[A-Z]?[a-z]+$", "abcdefghijklmnopqrstuvwxyz"),
    ("LETTERS", r"^[A-Z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", r"^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", r"^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base62", r"^[0-9A-Za-z]+$", LETTERS_AND_DIGITS),
    ("base64", r"^[0-9A-Za-z+/]+=*$", LETTERS_AND_DIGITS + "+/"),
    ("base64url", r"^[0-9A-Za-z_-]+=*$", LETTERS_AND_DIGITS + "-_"),
)
# Symbols of HEX repeat in prose about as often as by chance, so it has a null of its own. (So do
# those of decimal and hex, all of whose tokens are spans of the form "hex" anyway.) The wider
# encodings, and the number of their symbols without case.
NARROW = "HEX"
WIDER, WIDER_SYMBOLS = ("letters", "LETTERS", "base32", "base36", "base62"), 36
BATTERY = 11.345       # 99th percentile of chi-squared with three degrees of freedom
CLEAR = 30.665         # and one in a million: certainly not random
FALSE = 0.01           # false-discovery rate
PROSE_REPEATS = 0.065  # chance that two letters of prose agree, if the corpus has no words
MASK = "[secret]"


_MATCHES = "array<struct<kind:string,number:int,gap:int,match:string,holds:boolean>>"


def _matches(kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of a text's matches: kind, number, characters before it since the last, the match,
    and whether it holds."""
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all("text", F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split("text", pattern, -1)
    rows = F.transform(
        F.arrays_zip(gaps.alias("gap"), found.alias("found"), inner.alias("inner")),
        lambda m, i: F.struct(F.lit(kind).alias("kind"), i.alias("number"),
                              F.length(m["gap"]).alias("gap"), m["found"].alias("match"),
                              (F.length(m["inner"]) >= least).alias("holds")))
    return F.when(F.col("text").rlike(pattern), F.filter(rows, lambda m: m["match"].isNotNull())
                  ).otherwise(F.array().cast(_MATCHES))


def candidates(docs: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each match of each text (keys, kind, start, end, match), and one for each text
    without any, its kind null."""
    text = F.coalesce("text", F.lit("")).alias("text")
    forms = [*FORMS, *((f"{RANDOM}{i}", t, 0, 20) for i, t in enumerate(TOKENS))]
    found = (docs.select(*keys, text)
             .select(*keys, *(_matches(*f).alias(f"form{i}") for i, f in enumerate(forms)))
             .select(*keys, F.explode_outer(F.concat(*(f"form{i}" for i in range(len(forms)))))
                     .alias("m")).select(*keys, "m.*"))
    before = Window.partitionBy(*keys, "kind").orderBy("number")
    size = F.length("match")
    end = F.sum(F.col("gap") + size).over(before)
    return (found.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - size)
            .withColumn("kind", F.when(F.col("holds"), F.when(
                F.col("kind").startswith(RANDOM), RANDOM).otherwise(F.col("kind"))))
            .select(*keys, "kind", "start", "end", F.when(F.col("holds"), F.col("match"))
                    .alias("match")))


def _lower_tail(z: Column) -> Column:
    """Chance that a standard normal value is `z` or less, rounded up in the tail."""
    x = F.abs(z)
    tail = (2 * F.exp(-x * x / 2) / math.sqrt(2 * math.pi)) / (x + F.sqrt(x * x + 8 / math.pi))
    return F.when(z < 0, tail).otherwise(1 - tail)


def measured(tokens: DataFrame) -> DataFrame:
    """`tokens` (match) with encoding, n, repeats (equal pairs of symbols), the sum of the squared
    standard scores of the battery, and what the p-value needs."""
    encoding = F.lit(None).cast("string")
    alphabet = F.lit(None).cast("string")
    for name, pattern, symbols in reversed(ENCODINGS):
        fits = F.col("match").rlike(pattern)
        encoding = F.when(fits, F.lit(name)).otherwise(encoding)
        alphabet = F.when(fits, F.lit(symbols)).otherwise(alphabet)
    symbols = F.when(F.col("encoding") == "letters", F.lower("match")).otherwise(
        F.regexp_replace("match", "=+$", ""))
    known = (tokens.withColumn("encoding", encoding).withColumn("alphabet", alphabet)
             .withColumn("symbols", symbols).withColumn("n", F.length("symbols").cast("double"))
             .withColumn("k", F.length("alphabet").cast("double")))
    values = (known.withColumn("value", F.transform(
        F.split("symbols", ""), lambda c: F.instr(F.col("alphabet"), c).cast("double") - 1)))
    zero = F.lit(0.0)

    def total(array, each):
        return F.aggregate(array, zero, lambda acc, v: acc + each(v))

    def neighbours(pair):
        return F.zip_with(F.slice("value", F.lit(1), F.size("value") - 1),
                          F.slice("value", F.lit(2), F.size("value") - 1), pair)

    middle = F.col("k") / 2
    counted = (values.where("n >= 2").withColumn("mean", total(F.col("value"), lambda v: v) / F.col("n"))
               .withColumn("squares", F.aggregate(
                   F.array_distinct("value"), zero,
                   lambda acc, v: acc + F.pow(F.size(F.filter("value", lambda w: w == v)), F.lit(2.0))))
               .withColumn("spread", total(F.col("value"), lambda v: F.pow(v - F.col("mean"), F.lit(2))))
               .withColumn("changes", total(neighbours(
                   lambda a, b: ((a < middle) != (b < middle)).cast("double")), lambda v: v))
               .withColumn("lagged", total(neighbours(
                   lambda a, b: (a - F.col("mean")) * (b - F.col("mean"))), lambda v: v)))
    n, k = F.col("n"), F.col("k")
    return (counted.withColumn("chi", k / n * F.col("squares") - n)
            .withColumn("z_chi", (F.col("chi") - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n))
            .withColumn("z_runs", (F.col("changes") - (n - 1) / 2) / F.sqrt((n - 1) / 4))
            .withColumn("z_serial", F.when(F.col("spread") > 0, F.col("lagged") / F.col("spread")
                                           * F.sqrt(n)).otherwise(F.sqrt(n)))
            .withColumn("battery", F.pow(F.greatest("z_chi", F.lit(0.0)), F.lit(2))
                        + F.pow("z_runs", F.lit(2)) + F.pow("z_serial", F.lit(2)))
            .drop("value", "symbols", "alphabet", "mean", "spread", "changes", "lagged"))


def _neighbours(symbols: Column, pair) -> Column:
    return F.zip_with(F.slice(symbols, F.lit(1), F.size(symbols) - 1),
                      F.slice(symbols, F.lit(2), F.size(symbols) - 1), pair)


def _unlike(distinct: DataFrame) -> Column:
    """If over FALSE of the narrow tokens are certainly not random: the chance that one of these
    is as unlike them as a token is. Else 0."""
    narrow, clear = distinct.where(F.col("encoding") == NARROW), F.col("battery") >= CLEAR
    alphabet = next(symbols for name, _, symbols in ENCODINGS if name == NARROW)
    if (narrow.agg(F.avg(clear.cast("double"))).first()[0] or 0.0) <= FALSE:
        return F.lit(0.0)
    places = F.transform(F.split("match", ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
    k = len(alphabet)
    pairs = _neighbours(places, lambda a, b: a * k + b)
    counts = [[0] * k for _ in range(k)]                # rows of k x k pairs at most
    for pair, n in (narrow.where(clear).select(F.explode(pairs).alias("pair"))
                    .groupBy("pair").count().collect()):
        counts[pair // k][pair % k] = n
    every = sum(map(sum, counts))
    one = [(sum(row[b] for row in counts) + 1) / (every + k) for b in range(k)]
    two = [[(c + 5 * q) / (sum(row) + 5) for c, q in zip(row, one)] for row in counts]
    gain = [math.log(k * q) for row in two for q in row]
    weight = [p * q for p, row in zip(one, two) for q in row]
    mean = sum(w * g for w, g in zip(weight, gain))
    spread = sum(w * (g - mean) ** 2 for w, g in zip(weight, gain))
    table = F.array(*map(F.lit, gain))
    total = F.aggregate(pairs, F.lit(0.0), lambda acc, v: acc + F.element_at(table, v + 1))
    n = F.col("n") - 1
    return _lower_tail((total - n * mean) / F.sqrt(n * max(spread, 1e-9)))


def random_tokens(found: DataFrame, false: float = FALSE) -> DataFrame:
    """The rows of `found` that look random."""
    tokens = settle(measured(found.where(F.col("kind") == RANDOM).where("match is not null"))
                    .where("encoding is not null"), "tokens")
    # All figures are of distinct tokens: copies are no evidence of their own. A verdict follows
    # from a token's own scores and its group's limit, so every copy gets it in place.
    distinct = tokens.drop(*(c for c in found.columns if c != "match")).distinct()
    word = distinct.where("encoding in ('letters', 'LETTERS')")
    repeats = word.agg(F.sum(F.col("squares") - F.col("n"))
                       / F.sum(F.col("n") * (F.col("n") - 1))).first()[0] or PROSE_REPEATS
    wider = F.sum(F.length(F.regexp_replace("match", "[^0-9A-Fa-f]", ""))) / F.sum("n")
    seen = distinct.where(F.col("encoding").isin(*WIDER)).agg(wider).first()[0] or 0.0
    n, k = F.col("n"), F.col("k")
    share = F.greatest(k / WIDER_SYMBOLS, F.lit(seen))
    excess = (n - 1) * F.greatest(k * F.lit(repeats) - 1, F.lit(0.0))
    chance = F.when(F.col("encoding") == NARROW,
                    F.greatest(F.pow(share, n), _unlike(distinct))).otherwise(
        _lower_tail((F.col("chi") - (k - 1) - excess) / F.sqrt(2 * (k - 1) + 4 * excess)))

    def scored(rows):
        return (rows.withColumn("bin", F.floor(-10 * F.log10(F.greatest(chance, F.lit(1e-300)))))
                .withColumn("stratum", F.floor(2 * F.log2("n"))))

    # A bin's largest p-value against the share of tokens up to it; encodings x lengths x bins.
    bins = scored(distinct).groupBy("encoding", "stratum", "bin").agg(
        F.count(F.lit(1)).alias("all"), F.count_if(F.col("battery") < BATTERY).alias("passed"))
    group = Window.partitionBy("encoding", "stratum")
    reached = F.sum("all").over(group.orderBy(F.desc("bin")))
    held = F.pow(F.lit(10.0), -F.col("bin") / 10) * F.sum("all").over(group) <= false * reached
    limits = (bins.withColumn("held", held).where("held").groupBy("encoding", "stratum")
              .agg(F.min("bin").alias("limit")))
    return (scored(tokens).join(F.broadcast(limits), ["encoding", "stratum"])
            .where((F.col("bin") >= F.col("limit")) & (F.col("battery") < BATTERY))
            .select(*found.columns))


def _order(kind: Column) -> Column:
    names = [f[0] for f in FORMS] + [RANDOM]
    return F.array_position(F.array(*map(F.lit, names)), kind)


def spans(docs: DataFrame, keys: list[str]) -> DataFrame:
    """One row per text: keys, `base` and `all`, arrays of (start, rank, end, kind) in order. A
    random token that touches a base span, or lies inside another one, is not listed."""
    found = settle(candidates(docs, keys), "candidates")
    # Rows of texts without a match stay, with a null span.
    listed = (found.where(F.col("kind").isNull() | (F.col("kind") != RANDOM))
              .unionByName(found.where(F.col("kind") == RANDOM).select(
                  *keys, *(F.lit(None).cast(found.schema[c].dataType).alias(c)
                           for c in ("kind", "start", "end", "match"))).distinct())
              .unionByName(random_tokens(found)))
    # Base spans that begin at or before a row's start, and at or after it.
    text, base, end = Window.partitionBy(*keys), F.col("kind") != RANDOM, F.col("end")
    before = F.max(F.when(base, end)).over(text.orderBy("start"))
    after = F.min(F.when(base, F.col("start"))).over(text.orderBy(F.desc("start")))
    touched = F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < end, F.lit(False))
    longer = text.orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.max(F.when(F.col("alone"), end)).over(longer) >= end
    span = F.when(base | F.col("alone") & ~F.coalesce(F.col("inside"), F.lit(False)),
                  F.struct("start", _order(F.col("kind")).alias("rank"), "end", "kind"))
    return (listed.withColumn("alone", ~base & ~touched).withColumn("inside", inside)
            .groupBy(*keys).agg(F.array_sort(F.collect_list(span)).alias("all"))
            .withColumn("base", F.filter("all", lambda s: s["kind"] != RANDOM)))


def _listed(array: str) -> Column:
    return F.array_join(F.transform(array, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    marked = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))

    def count(kind):
        return F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans(marked, ["row", "doc_id"]).select(
        "doc_id", *(count(f[0]) for f in FORMS), F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("all").alias("spans"), count(RANDOM))


def redact(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """`docs` with every span replaced by `mask`; n_chars, if there, follows the text."""
    row, place = fresh(docs, "row"), fresh(docs, "spans")
    marked = settle(docs.withColumn(row, F.monotonically_increasing_id()), "marked")
    found = (spans(marked.select(F.col(row).alias("row"), "text"), ["row"])
             .where(F.size("all") > 0).select(F.col("row").alias(row), F.col("all").alias(place)))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def piece(low, high):
        return F.substring("text", (low + 1).cast("int"), F.greatest(high - low, F.lit(0)).cast("int"))

    parts = F.aggregate(place, start, lambda acc, s: F.when(
        s["end"] <= acc["at"], acc).otherwise(F.struct(
            F.concat(acc["out"], piece(acc["at"], s["start"]),
                     F.when(s["start"] >= acc["at"], F.lit(mask)).otherwise(F.lit("")))
            .alias("out"), s["end"].alias("at"))))
    clean = F.concat(parts["out"], piece(parts["at"], F.length("text").cast("long")))
    text = F.when(F.col(place).isNull(), F.col("text")).otherwise(clean)
    joined = marked.join(found, row, "left").withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        joined = joined.withColumn("n_chars", F.when(F.col(place).isNull(), F.col("n_chars"))
                                   .otherwise(F.length("text")).cast(kind))
    return joined.select(*quoted(docs.columns))
