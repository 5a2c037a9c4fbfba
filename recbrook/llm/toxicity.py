"""Toxicity scores: gradient-boosted trees over dense features, calibrated by
isotonic regression.

A text is cut at white space; the features are rates over its tokens and bytes:
densities of a fixed and of a learned lexicon, how near second-person words the
hits stand, the densest window, capitals, punctuation, and obfuscation (digits
and symbols inside words, spaced letters, stretched letters).

About ``SAMPLE`` labelled rows are split by a hash of the id into two folds and
a rest.  Each fold teaches a lexicon (words and word beginnings that mark the
label), the trees see each fold's rows by the other's lexicon, and the rest
calibrates, so no part is fitted on what an earlier one has seen.  Documents are
scored where they lie, by the lexicon of both folds; no text is shuffled.
"""

from __future__ import annotations

import re
import string
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Labelled rows that are fitted on, terms of the learned lexicon, and the
#: documents a term must be in.
SAMPLE, TERMS, MIN_DOCS = 60_000, 2000, 3
THRESHOLD, STEMS = 0.7, (3, 4, 5, 6, 7)
WINDOW, NEAR = 50, 5

# Insults of the languages at hand, and words of address.
INSULTS = """
arsehole asshole bastard bitch clown coward creep cretin degenerate disgusting dumb dumbass dunce fool freak
idiot imbecile jerk loser lowlife maggot moron pathetic pig retard scum scumbag stupid trash twat ugly vermin
wanker worthless
abschaum arschloch blödmann depp drecksau dummkopf idiotin miststück schwachkopf trottel versager wichser
abruti bouffon connard connasse crétin débile imbécile minable ordure salaud salope
basura cabrón escoria estúpido gilipollas idiota imbécil inútil payaso pendejo
""".split()
ADDRESS = """
u ur you your yours yourself youre ya
du dich dir dein deine deinen deiner ihr euch euer eure sie
tu te toi ton ta tes vous vos votre
tú ti usted ustedes vosotros vuestro os
""".split()
# Characters that stand in for letters.
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
                           "!": "i", "|": "l", "+": "t", "€": "e"})
#: Bits of a token's code: a word, a learned hit, a fixed hit, a hit only once
#: folded, address, mixed, capitals, one letter; a weight in sixteenths above.
WORD, LEARNED, FIXED, FOLDED, SECOND, MIXED, SHOUT, SINGLE = (1 << i for i in range(8))
FEATURES = 22


def letters(token: str) -> str:
    return "".join(c for c in token if c.isalpha())


_MARKS = re.compile("[\u0300-\u036f]+")
_STRETCHED = re.compile(r"(.)\1{2,}")
_PUNCTUATION = ".,;:!?\"'()[]{}«»„“”‘’-–…"
_SYMBOLS = "#$%&*@+|_~^=<>/\\"


def plain(word: str) -> str:
    """Without accents, stretched letters once."""
    if not word.isascii():
        word = _MARKS.sub("", unicodedata.normalize("NFD", word))
    return _STRETCHED.sub(r"\1", word)


class Tokens(dict):
    """Code of a token, computed once while the dict is small."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon, self.address = lexicon, frozenset(ADDRESS)
        self.fixed = frozenset(INSULTS) | {plain(w) for w in INSULTS}
        self.begun: dict[str, bool] = {}
        #: How words of the lexicons begin, stretched or not; most words do not.
        known = [w.rstrip("*") for w in (*lexicon, *self.fixed, *self.address)]
        self.heads = frozenset(h for w in known for h in (w[:3], 3 * w[:1], w[:1] + 2 * w[1:2]))

    def weight(self, word: str) -> float:
        """The largest weight of the word and of its beginnings."""
        get = self.lexicon.get
        return max(get(word, 0.0), *[get(word[:k] + "*", 0.0) if len(word) > k else 0.0 for k in STEMS])

    def code(self, token: str) -> int:
        t = token.lower()
        core = t.strip(_PUNCTUATION)
        word = core if core.isalpha() else letters(t)
        if not word:
            return 0
        out = WORD
        weight = self.weight(word)
        if weight:
            out |= LEARNED
        if word in self.fixed or plain(word) in self.fixed:
            out |= FIXED
        if core != word:
            inner = letters(core.translate(STAND_INS))
            if core[0].isalnum() or core[-1].isalnum() or word != core.strip(_SYMBOLS):
                out |= MIXED
            folded = self.weight(inner)
            if inner != word and not out & (LEARNED | FIXED) and (folded or inner in self.fixed):
                out |= FOLDED
                weight = folded
        if word in self.address:
            out |= SECOND
        if len(word) > 1 and token.isupper():
            out |= SHOUT
        if len(word) == len(t) == 1:
            out |= SINGLE
        return out | int(min(weight, 4000) * 16) << 8

    def begins(self, head: str) -> bool:
        """Whether a word of the lexicons begins like ``head``; remembered."""
        if len(self.begun) > 100_000:
            self.begun.clear()
        h = head.lower()
        self.begun[head] = out = h in self.heads or not h.isascii() and plain(h)[:3] in self.heads
        return out

    def __missing__(self, token: str) -> int:
        # The common case at once: a plain word that begins like none of the lexicons'.
        core = token.strip(_PUNCTUATION)
        head = core[:3]
        begins = self.begun.get(head)
        if core.isalpha() and not (self.begins(head) if begins is None else begins):
            c = WORD
            if token.isupper():
                c |= SHOUT if len(core) > 1 else 0
            if len(token) == 1:
                c |= SINGLE
        else:
            c = self.code(token)
        if len(token) < 100:
            if len(self) > 500_000:
                self.clear()
            self[token] = c
        return c


# Rows that add up a histogram of codes' low bits, and one of bytes.
_FLAGS = np.array([[code >> bit & 1 for code in range(256)] for bit in range(8)])
_BYTES = np.array([[chr(c) in group for c in range(256)] for group in (
    string.ascii_uppercase, string.ascii_letters, string.punctuation[:15] + ":;<=>?@", "!?", "#$%&*@^~")], np.int64)


def spaced(tokens: list[str], single: np.ndarray, known: Tokens) -> list[int]:
    """Places where four or more one-letter tokens in a row spell a hit."""
    at = np.flatnonzero(single)
    found = []
    for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
        if len(run) >= 4 and known.code("".join(tokens[run[0]:run[-1] + 1])) & (LEARNED | FIXED):
            found.append(int(run[0]))
    return found


def features(text: str, known: Tokens) -> np.ndarray:
    tokens = text.split()
    c = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
    flags = _FLAGS @ np.bincount(c & 255, minlength=256)
    words = max(1, int(flags[0]))
    out = np.zeros(FEATURES)
    if flags[1:4].any() or flags[7] >= 4:
        out[:13] = hit_features(tokens, c, flags, words, known)
    else:
        out[10] = flags[4] / words
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    upper, alpha, marks, loud, symbols = (_BYTES @ np.bincount(raw, minlength=256)).tolist()
    size, stretched = max(1, len(raw)), 0
    if len(raw) > 2:
        same = raw[1:] == raw[:-1]
        stretched = np.count_nonzero(same[1:] & same[:-1] & (raw[2:] > 64))
    out[13:] = (upper / max(1, alpha), flags[6] / words, marks / size, loud / size,
                (text.count("!!") + text.count("??")) / words, flags[5] / words, symbols / size, stretched / size,
                np.log1p(len(tokens)))
    return out


def hit_features(tokens: list[str], c: np.ndarray, flags: np.ndarray, words: int, known: Tokens):
    """Densities of the hits, their evidence, and their distance to words of address."""
    hit = (c & (LEARNED | FIXED | FOLDED)) > 0
    sp = spaced(tokens, (c & SINGLE) > 0, known) if flags[7] >= 4 else []
    hit[sp] = True
    at, second = np.flatnonzero(hit), np.flatnonzero(c & SECOND)
    close = 0
    if len(at) and len(second):
        i = np.searchsorted(second, at)
        gap = np.minimum(np.abs(at - second[np.minimum(i, len(second) - 1)]), np.abs(at - second[np.maximum(i - 1, 0)]))
        close = int((gap <= NEAR).sum())
    run = np.concatenate([[0], np.cumsum(hit)])
    dense = int((run[WINDOW:] - run[:-WINDOW]).max()) if len(run) > WINDOW else int(run[-1])
    weight = c >> 8
    distinct = {tokens[i].lower(): int(weight[i]) for i in at}
    return (flags[1] / words, flags[2] / words, (flags[3] + len(sp)) / words, len(at) / words, np.log1p(len(at)), dense,
            len(distinct), np.log1p(sum(distinct.values()) / 16), weight.sum() / 16 / words,
            np.log1p(weight.max(initial=0) / 16), flags[4] / words, close / words, close / max(1, len(at)))


def split_labels(labels: DataFrame, id_col: str, label: str, usable: Column, sample: int) -> DataFrame:
    """(doc_id, toxic, fold) of about ``sample`` labelled ids, by a hash of the id."""
    rows = (labels.select(F.col(id_col).cast("bigint").alias("doc_id"), (F.col(label) == 1).cast("int").alias("toxic"))
            .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(usable))
    span = 1 << 40
    share = min(1.0, sample / max(1, rows.count()))
    h = F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(span))
    fold = F.pmod(F.xxhash64(F.lit(29), "doc_id"), F.lit(10))
    return rows.filter(h < int(span * share)).withColumn(
        "fold", F.when(fold < 4, 0).when(fold < 8, 1).otherwise(2))


def lexicon(taught: DataFrame, terms: int = TERMS) -> dict[str, float]:
    """The words and word beginnings that mark the label most clearly, ``terms``
    at most, each with its evidence: the gain in log likelihood of knowing
    the term.  It has to exceed half the logarithm of the number of terms tried,
    so that what chance lets in stays weak beside what marks the label."""
    n = taught.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    if not n[0] or not n[1]:
        return {}
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    stems = [F.transform(F.filter("words", lambda w, k=k: F.length(w) > k), lambda w, k=k: F.concat(F.substring(w, 1, k), F.lit("*")))
             for k in STEMS]
    each = (taught.select("toxic", words.alias("words"))
            .select("toxic", F.explode(F.array_distinct(F.concat(F.col("words"), *stems))).alias("term"))
            .groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
            .filter(F.col("a") + F.col("b") >= MIN_DOCS))
    each = written(each, "toxicity-terms")
    share = n[0] / (n[0] + n[1])
    both = F.col("a") + F.col("b")
    gain = F.col("a") * F.log(F.col("a") / (both * share)) + F.when(F.col("b") > 0, F.col("b") * F.log(
        F.col("b") / (both * (1 - share)))).otherwise(0.0)
    odds = F.log((F.col("a") + 0.5) / (n[0] + 1)) - F.log((F.col("b") + 0.5) / (n[1] + 1))
    best = (each.filter(F.col("a") >= MIN_DOCS).select("term", gain.alias("gain"), odds.alias("odds"))
            .filter(f"odds > 2 and gain > ln({max(1, each.count())}) / 2").orderBy(F.desc("gain"), "term").limit(terms))
    return {r.term: float(r.gain) for r in best.collect()}


def with_features(docs: DataFrame, text: str, terms: dict[str, float]) -> DataFrame:
    """``docs`` with the column ``__x``: the features of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # TERMS short strings at most

    @F.pandas_udf("array<double>")
    def x(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Tokens(shared.value)
        for texts in batches:
            yield pd.Series([features(t or "", known) for t in texts])

    return docs.withColumn("__x", x(text))


class Model:
    """Lexicon, trees and calibration; or only the share of the label, where
    the labelled rows hold fewer than two classes."""

    def __init__(self, terms=None, trees=None, isotonic=None, share: float = 0.0):
        self.terms, self.trees, self.isotonic, self.share = terms or {}, trees, isotonic, share


def trees_on(rows: DataFrame):
    return GBTClassifier(featuresCol="__v", labelCol="toxic", maxIter=30, maxDepth=4, stepSize=0.2, minInstancesPerNode=3, seed=17).fit(rows)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text: str = "text",
        label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Learns from the labelled rows of ``docs`` whose ``doc_id`` is ``usable``."""
    marked = split_labels(labels, id_col, label, usable, sample)
    taught = written(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
                     .join(F.broadcast(marked), "doc_id"), "toxicity-taught")  # ``sample`` short rows at most
    held = {(r.fold, r.toxic): r["count"] for r in taught.groupBy("fold", "toxic").count().collect()}  # six rows
    count = {y: sum(n for (_, v), n in held.items() if v == y) for y in (0, 1)}
    if not count[0] or not count[1]:
        return Model(share=1.0 if count[1] else 0.0)
    # Few rows: no calibration, the trees' own probability stands.
    enough = min(held.get((2, y), 0) for y in (0, 1)) >= 10
    folds = F.col("fold") if enough else F.when(F.col("fold") == 2, F.xxhash64("doc_id") % 2 == 0).otherwise(F.col("fold") == 0).cast("int")
    taught = taught.withColumn("fold", folds)
    by = [lexicon(taught.filter(f"fold = {f}")) for f in (0, 1)]
    terms = lexicon(taught.filter("fold < 2"))

    def seen(fold: int, known: dict[str, float]) -> DataFrame:
        return with_features(taught.filter(F.col("fold") == fold), "text", known).select("doc_id", "toxic", "fold", "__x")

    rows = seen(0, by[1]).unionByName(seen(1, by[0])).unionByName(seen(2, terms))
    rows = written(rows, "toxicity-features").select(
        F.col("doc_id"), F.col("toxic").cast("double").alias("toxic"), "fold", array_to_vector("__x").alias("__v"))
    mine = rows.filter("fold < 2")
    trees = trees_on(mine.repartition(1).sortWithinPartitions("doc_id", "toxic"))  # bounded; one order, one model
    if not enough:
        return Model(terms, trees)
    scored = trees.transform(rows.filter("fold = 2")).select("toxic", vector_to_array("probability")[1].alias("__q"))
    return Model(terms, trees, IsotonicRegression(featuresCol="__q", labelCol="toxic", predictionCol="__c").fit(scored))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) per row of ``docs``: the calibrated
    probability (a hundredth of the trees' own keeps the order within its
    steps) and whether it reaches ``THRESHOLD``.

    Null and empty texts are scored as texts without a word; repeated rows
    score alike; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).alias("__text"))
    if model.trees is None:
        p = F.lit(float(model.share))
    else:
        rows = with_features(rows, "__text", model.terms).select("doc_id", array_to_vector("__x").alias("__v"))
        rows = model.trees.transform(rows).select("doc_id", vector_to_array("probability")[1].alias("__q"))
        p = F.col("__q")
        if model.isotonic is not None:
            rows = model.isotonic.transform(rows)
            p = 0.99 * F.col("__c") + 0.01 * p
    return rows.select("doc_id", F.least(F.lit(1.0), F.greatest(F.lit(0.0), p)).alias("score")) \
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows no label is learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
