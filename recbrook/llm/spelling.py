"""Spelling variant grouping by blocked Gram matrices.

Words one edit apart have letter-count vectors at squared distance one (a
letter more) or two (a letter replaced).  Words are dealt to blocks of equal
letter counts over a few groups of letters, so a block has one length, and the
only blocks that can hold a word's neighbours are its own, those with one letter
moved to another group, and those with one letter more.  Blocks are packed in
chunks of at most ``CHUNK`` words; for each pair of chunks NumPy multiplies the
letter-count matrices, the squared distances follow from the products, and the
pairs at the right distance are verified letter by letter.

The number of letter groups grows with the logarithm of the vocabulary.  A
block's chunks and those that visit it are dealt to tiles of ``TILE`` by
``TILE`` chunks, so a block that holds a third of all words is many tasks'
work.  A pair of chunks gives one row per word that has a neighbour (how many,
and the most frequent), never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_parts, written

CHUNK, CHUNK_BYTES, TILE = 256, 1 << 16, 64
LEAST, TIMES = 7, 10
_RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Column of a letter in the count matrix; the alphabet has 90 letters.
_COLUMN = np.zeros(256, np.int64)
_COLUMN[[*range(97, 123), *range(0xC0, 0x100)]] = np.arange(90)


def spelled_words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(word, n): the words of ``least`` letters or more that occur twice or
    more.  Where 31 divides the crc32 of ``<id>:<run>`` the run loses its letter
    at the crc32 modulo its length.  Null texts have no words, a null id is
    spelt as nothing."""
    runs = (docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                        F.explode(F.regexp_extract_all(F.col(text), F.lit(_RUN), F.lit(0))).alias("run"))
            .filter(F.length("run") >= least)
            .select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
            .select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h")))
    at = "cast(h % length(run) as int)"
    word = F.when(F.col("h") % 31 == 0, F.expr(f"concat(substring(run, 1, {at}), substring(run, {at} + 2))")) \
        .otherwise(F.col("run"))
    return (runs.select(word.alias("word")).filter(F.length("word") >= least)
            .groupBy("word").agg(F.count("*").alias("n")).filter("n >= 2"))


def letter_groups(words: DataFrame, groups: int) -> list[str]:
    """The letters in ``groups`` strings of about equal occurrences over the
    vocabulary.  At most 90 rows reach the driver."""
    totals = (words.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''")
              .groupBy("letter").count().collect())
    out, held = [""] * groups, [0] * groups
    for r in sorted(totals, key=lambda r: (-r["count"], r["letter"])):
        g = held.index(min(held))
        out[g] += r["letter"]
        held[g] += r["count"]
    return out


def steps(groups: int) -> list[tuple[int, list[int]]]:
    """(kind, change of counts) from a block to those it visits: 0 itself, 1 a
    letter moved to a later group (one way is enough), 2 a letter more."""
    def change(*parts):
        d = [0] * groups
        for g, v in parts:
            d[g] += v
        return d
    return ([(0, change())] + [(1, change((a, -1), (b, 1))) for a in range(groups) for b in range(a + 1, groups)]
            + [(2, change((a, 1))) for a in range(groups)])


class Chunk:
    """Words of one length: letters (n, length), letter counts, squared norms."""

    def __init__(self, text: str, width: int):
        self.codes = np.frombuffer(text.encode("latin-1"), np.uint8).reshape(-1, width)
        n = len(self.codes)
        at = _COLUMN[self.codes] + 90 * np.arange(n)[:, None]
        kind = np.float32 if width < 4096 else np.float64  # products stay exact
        self.counts = np.bincount(at.ravel(), minlength=90 * n).reshape(n, 90).astype(kind)
        self.square = (self.counts * self.counts).sum(1)


def near(x: Chunk, y: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs one edit apart; ``y``'s words are as long as ``x``'s or one shorter."""
    shorter = x.codes.shape[1] - y.codes.shape[1]
    distance = x.square[:, None] + y.square - 2 * (x.counts @ y.counts.T)
    i, j = np.nonzero(distance == (1 if shorter else 2))
    width = max(1, y.codes.shape[1])
    ok = np.zeros(len(i), bool)
    step = max(1, (1 << 22) // width)
    for s in range(0, len(i), step):
        a, b = x.codes[i[s:s + step]], y.codes[j[s:s + step]]
        if shorter:
            head = np.cumprod(a[:, :-1] == b, axis=1, dtype=np.int32).sum(1)
            tail = np.cumprod((a[:, 1:] == b)[:, ::-1], axis=1, dtype=np.int32).sum(1)
            ok[s:s + step] = head + tail >= width
        else:
            ok[s:s + step] = (a != b).sum(1) == 1
    return i[ok], j[ok]


def best_of(owner: np.ndarray, other: np.ndarray, n: np.ndarray):
    """(owners, their number of others, the other of largest ``n``); others are
    indices in code-point order, the first wins ties."""
    order = np.lexsort((other, -n[other], owner))
    owners, first, count = np.unique(owner[order], return_index=True, return_counts=True)
    return owners, count, other[order][first]


FOUND = "word string, near bigint, form_n bigint, form string"


def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows are pairs of chunks: home text, ns, width; visitor v_text, v_ns; kind; same."""
    known: dict[tuple[str, int], Chunk] = {}

    def chunk(text: str, width: int) -> Chunk:
        if (text, width) not in known:
            if len(known) >= 256:
                known.clear()
            known[text, width] = Chunk(text, width)
        return known[text, width]

    for pdf in batches:
        out = []
        for a, an, width, b, bn, kind, same in zip(*(pdf[c] for c in ("text", "ns", "width", "v_text", "v_ns", "kind", "same"))):
            less = width - (kind == 2)
            i, j = near(chunk(a, width), chunk(b, less))
            if same:
                once = i < j
                i, j = i[once], j[once]
            if len(i):
                for who, whom, n, mine, w, theirs, v in ((i, j, bn, a, width, b, less), (j, i, an, b, less, a, width)):
                    for o, c, f in zip(*(z.tolist() for z in best_of(who, whom, n))):
                        out.append((mine[o * w:o * w + w], c, int(n[f]), theirs[f * v:f * v + v]))
        yield pd.DataFrame(out, columns=["word", "near", "form_n", "form"])


def packed_blocks(words: DataFrame, groups: list[str]) -> DataFrame:
    """(key, chunk, chunk_id, width, text, ns): the words of a chunk in
    code-point order, one after the other, and their numbers."""
    key = F.array(*[F.length("word") - F.length(F.translate("word", g, "")) if g else F.lit(0) for g in groups])
    keyed = words.select("word", "n", key.alias("key"))
    per = F.greatest(F.lit(1), F.least(F.lit(CHUNK), F.floor(F.lit(CHUNK_BYTES) / F.length("word"))))
    sizes = keyed.groupBy("key").agg(F.ceil(F.count("*") / F.min(per)).cast("int").alias("chunks"))
    return (keyed.join(sizes, "key")
            .groupBy("key", F.pmod(F.xxhash64("word"), "chunks").cast("int").alias("chunk"))
            .agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("held"))  # some CHUNK words
            .select("key", "chunk", F.length(F.col("held")[0]["word"]).alias("width"),
                    F.array_join(F.col("held")["word"], "").alias("text"), F.col("held")["n"].alias("ns")))


def variants(words: DataFrame) -> DataFrame:
    """(word, near, form_n, form) for each word of ``words`` (word, n) that has
    another one edit apart: how many, and the most frequent of them."""
    size = words.count()
    groups = letter_groups(words, max(3, round(math.log10(size)) if size else 0))
    blocks = written(packed_blocks(words, groups), "spelling-blocks")
    moves = F.array(*[F.struct(F.lit(k).alias("kind"), F.array(*map(F.lit, d)).alias("by")) for k, d in steps(len(groups))])
    visits = (blocks.withColumnsRenamed({"key": "of", "chunk": "v_chunk", "text": "v_text", "ns": "v_ns"}).drop("width")
              .withColumn("move", F.explode(moves))
              .withColumn("key", F.zip_with("of", "move.by", lambda a, b: a + b)).withColumn("kind", F.col("move.kind"))
              .filter(~F.exists("key", lambda c: c < 0)).drop("move"))
    tiles = (visits.groupBy("key").agg(F.ceil(F.count("*") / TILE).cast("int").alias("vs"))
             .join(blocks.groupBy("key").agg(F.ceil(F.count("*") / TILE).cast("int").alias("hs")), "key"))

    def all_of(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    parts = shuffle_parts(words.sparkSession)
    home = (blocks.join(tiles, "key").withColumn("h", F.pmod("chunk", "hs")).withColumn("v", all_of("vs"))
            .drop("hs", "vs").repartition(parts, "key", "h", "v"))
    visit = (visits.join(tiles, "key").withColumn("v", F.pmod(F.xxhash64("of", "v_chunk"), "vs").cast("int"))
             .withColumn("h", all_of("hs")).drop("hs", "vs", "of").repartition(parts, "key", "h", "v"))
    same = (F.col("kind") == 0) & (F.col("chunk") == F.col("v_chunk"))
    pairs = (home.join(visit.hint("merge"), ["key", "h", "v"])
             .filter((F.col("kind") > 0) | (F.col("v_chunk") <= F.col("chunk")))
             .select("text", "ns", "width", "v_text", "v_ns", "kind", same.alias("same")))
    return (pairs.mapInPandas(compare, FOUND)
            .groupBy("word").agg(F.sum("near").alias("near"), F.min(F.struct((-F.col("form_n")).alias("m"), "form")).alias("f"))
            .select("word", "near", (-F.col("f.m")).alias("form_n"), "f.form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last, twice as far
    each round; a form is ``TIMES`` as frequent as its word, so chains are short."""
    at = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if at.join(on, "root", "left_semi").isEmpty():
            return at
        at = written(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", times: int = TIMES) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are runs of letters of the whole texts, with ``spelled_words``'
    deletions.  n_near counts the words one insertion, deletion or replacement
    away; form is the most frequent of them (ties: the smallest), if it is
    ``times`` as frequent as the word, else null; root is where forms lead, or
    the word.  Null and empty texts and texts without letters add nothing; repeated
    rows count each time; other columns are not read; no words give no rows.
    """
    words = written(spelled_words(docs, id_col, text), "spelling-words")
    found = words.join(variants(words), "word", "left")
    is_form = F.col("form_n") >= F.col("n") * times
    found = written(found.select("word", "n", F.coalesce("near", F.lit(0)).cast("bigint").alias("n_near"),
                                 F.when(is_form, F.col("form")).alias("form"),
                                 F.when(is_form, F.col("form_n")).alias("form_n")), "spelling-found")
    last = roots(found.filter("form is not null"))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
