"""Cross-entropy difference scoring with word n-grams.

Two bigram models of one vocabulary and one smoothing are counted over the
whole corpus: one of the target documents, one of the background (all
documents).  The vocabulary is every word of the corpus, as it is spelt: runs
of letters, digits and combining marks, every other visible character, and each
ideograph or kana, by itself.  A document is its words and an end mark.  Its
score is the mean over these of the target model's loss minus the background
model's; low is like the target.

p(w) = (c(w) + 1) / (N + V + 1) and p(w | h) = (c(h w) + PRIOR p(w)) / (c(h) +
PRIOR): a context never seen falls back to p(w), an empty model is uniform over
the vocabulary and one word for the unseen.

Nothing of the model is held in one place.  Documents are dealt to blocks by a
hash of their id; a block's distinct words and bigrams, as 64-bit hashes, go
with their counts to ranges of hashes, where counts of equal hashes are added
up and go back to the blocks that asked, so a word that every document has is
a row a block.  Blocks and ranges hold about ``BLOCK`` and ``RANGE`` bytes of
text each, so their number grows with the corpus.  A block and a range exchange
a row only where the block has a word or bigram of the range, so rows are
bounded by the distinct ones of all blocks, which grow in line with the text.

A document's own words are in both counts: a target document scores itself
the better for it, and a document that occurs twice scores lower in the background.
"""

from __future__ import annotations

import re
import zlib
from hashlib import blake2b

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

PRIOR, BLOCK, RANGE = 10.0, 4 << 20, 16 << 20
_TOKEN = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]|[\p{L}\p{M}\p{N}--\p{Han}--\p{Hiragana}--\p{Katakana}]+|[^\s\p{L}\p{M}\p{N}]",
                       regex.V1).findall
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _ranges(points: list[int]) -> str:
    """The code points as ranges of a character class."""
    cut = np.flatnonzero(np.diff(points) > 1)
    firsts, lasts = [points[0], *(points[i + 1] for i in cut)], [*(points[i] for i in cut), points[-1]]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(firsts, lasts))


# Below the ideographs a word is a run of one class, which the plain matcher
# finds several times faster; other texts take the full pattern.
_IDEOGRAPHS = 0x2E80
_CLASS = {k: _ranges([c for c in range(_IDEOGRAPHS) if regex.match(p, chr(c))])
          for k, p in (("word", r"[\p{L}\p{M}\p{N}]"), ("space", r"\s"))}
_PLAIN = re.compile(f"[{_CLASS['word']}]+|[^{_CLASS['word']}{_CLASS['space']}]").findall
_BEYOND = re.compile(f"[\\u{_IDEOGRAPHS:04x}-\U0010ffff]").search


def tokens(text: str) -> list[str]:
    return _TOKEN(text) if _BEYOND(text) else _PLAIN(text)


class Hashes(dict):
    """64-bit hash of a word, computed once while the dict is small."""

    def __missing__(self, word: str) -> int:
        h = int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        if len(self) > 1_000_000:
            self.clear()
        self[word] = h
        return h


START, END = (int.from_bytes(blake2b(x, digest_size=8, person=b"mark").digest(), "little") for x in (b"start", b"end"))


def grams(text: str, hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """(words, bigrams): the hash of the start, the words and the end, and of
    each but the first with the one before it; empty without a word."""
    found = tokens(text)
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    w = np.fromiter((START, *map(hashes.__getitem__, found), END), np.uint64, len(found) + 2)
    g = w[:-1] * _MIX
    g ^= g >> np.uint64(29)
    g = (g + w[1:]) * np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(32)
    return w, g * np.uint64(0x94D049BB133111EB)


def counted(keys: list[np.ndarray], hits: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys ascending, their counts in all and in the hits, 2 rows)."""
    if not keys:
        return np.empty(0, np.uint64), np.zeros((2, 0), np.int64)
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    hit = np.repeat(np.array(hits, float), [len(k) for k in keys])
    return every, np.stack([np.bincount(at, minlength=len(every)),
                            np.bincount(at, hit, len(every)).astype(np.int64)])


def pack(a: np.ndarray) -> bytes:
    """64-bit numbers by planes of equal bytes, compressed; ascending rows as differences."""
    a = np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8)
    return zlib.compress(np.ascontiguousarray(a.T).tobytes(), 1)


def unpack(b: bytes, kind) -> np.ndarray:
    a = np.frombuffer(zlib.decompress(b), np.uint8)
    return np.ascontiguousarray(a.reshape(8, -1).T).reshape(-1).view(kind)


def steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def place(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each key; ascending with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def block_grams(pdf: pd.DataFrame) -> tuple[list, list, list]:
    """(documents: id and whether target; their words; their bigrams), in an
    order that depends on the rows alone."""
    good = set(pdf.loc[pdf["role"] == 1, "doc_id"].dropna().astype("int64"))
    hashes, docs, w, g = Hashes(), [], [], []
    for doc_id, text in zip(pdf.loc[pdf["role"] == 0, "doc_id"], pdf.loc[pdf["role"] == 0, "text"]):
        doc_id = None if pd.isna(doc_id) else int(doc_id)
        docs.append((doc_id, doc_id in good))
        a, b = grams(text or "", hashes)
        w.append(a)
        g.append(b)
    return docs, w, g


ASKED = "range int, block int, words int, keys binary, counts binary"
TOLD = "block int, range int, counts binary, v bigint, n bigint, t bigint"


def ask(ranges: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["block"].iat[0])
        docs, w, g = block_grams(pdf)
        hits = [t for _, t in docs]
        (wk, wc), (gk, gc) = counted(w, hits), counted(g, hits)
        out = []
        we, ge = (np.searchsorted(place(k, ranges), np.arange(ranges + 1)) for k in (wk, gk))
        for r in range(ranges):
            a, b, c, d = we[r], we[r + 1], ge[r], ge[r + 1]
            if a < b or c < d:
                keys = np.concatenate([steps(wk[a:b]), steps(gk[c:d])])
                out.append((r, block, b - a, pack(keys), pack(np.concatenate([wc[:, a:b], gc[:, c:d]], 1))))
        return pd.DataFrame(out, columns=["range", "block", "words", "keys", "counts"])
    return run


def tell(pdf: pd.DataFrame) -> pd.DataFrame:
    """The counts over all blocks, to each block for the keys it asked of.
    The first row also has the range's distinct words, and their counts."""
    asked = []
    for words, keys, counts in zip(pdf["words"], pdf["keys"], pdf["counts"]):
        k = unpack(keys, np.uint64).copy()
        k[:words], k[words:] = np.cumsum(k[:words]), np.cumsum(k[words:])
        asked.append((k, np.arange(len(k)) < words, unpack(counts, np.int64).reshape(2, -1)))
    k = np.concatenate([a[0] for a in asked])
    word = np.concatenate([a[1] for a in asked])
    c = np.concatenate([a[2] for a in asked], 1).astype(float)  # exact below 2**53
    total = np.empty((2, len(k)), np.int64)
    v, sums = 0, np.zeros(2, np.int64)
    for kind in (word, ~word):
        every, at = np.unique(k[kind], return_inverse=True)
        s = np.stack([np.bincount(at, x[kind], len(every)) for x in c]).astype(np.int64)
        total[:, kind] = s[:, at]
        if kind is word:
            told = every != np.uint64(START)
            v, sums = int(told.sum()), s[:, told].sum(1)
    ends = np.cumsum([len(a[0]) for a in asked])
    out = pd.DataFrame({"block": pdf["block"].to_numpy(), "range": pdf["range"].to_numpy(),
                        "counts": [pack(total[:, e - len(a[0]):e]) for e, a in zip(ends, asked)]})
    first = np.arange(len(out)) == 0
    return out.assign(v=np.where(first, v, 0), n=np.where(first, sums[0], 0), t=np.where(first, sums[1], 0))


SCORED = "doc_id bigint, target boolean, n_symbols bigint, target_loss double, background_loss double"


def losses(ranges: int, v: int, sums: tuple[int, int]):
    """Scores a block's documents by the counts the ranges told it."""
    def run(pdf: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        docs, w, g = block_grams(pdf)
        rows = np.zeros((len(docs), 3))
        if any(len(x) for x in w):
            (wk, wc), (gk, gc) = (counted(x, [False] * len(docs)) for x in (w, g))
            wc, gc = wc.astype(float), gc.astype(float)
            we, ge = (np.searchsorted(place(k, ranges), np.arange(ranges + 1)) for k in (wk, gk))
            for r, counts in zip(told["range"], told["counts"]):
                c = unpack(counts, np.int64).reshape(2, -1)
                m = we[r + 1] - we[r]
                wc[:, we[r]:we[r + 1]], gc[:, ge[r]:ge[r + 1]] = c[:, :m], c[:, m:]
            for i, (words, pairs) in enumerate(zip(w, g)):
                if len(words):
                    c, cc = wc[:, np.searchsorted(wk, words)], gc[:, np.searchsorted(gk, pairs)]
                    loss = []
                    for model, n in ((1, sums[1]), (0, sums[0])):
                        p = (c[model, 1:] + 1) / (n + v + 1)
                        loss.append(-np.log((cc[model] + PRIOR * p) / (c[model, :-1] + PRIOR)).mean())
                    rows[i] = len(pairs), *loss
        return pd.DataFrame({"doc_id": pd.array([d for d, _ in docs], "Int64"), "target": [t for _, t in docs],
                             "n_symbols": rows[:, 0].astype("int64"), "target_loss": rows[:, 1],
                             "background_loss": rows[:, 2]})
    return run


def score(docs: DataFrame, good: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, target (its id is one of ``good``),
    n_symbols (words and the end), target_loss, background_loss (nats a symbol)
    and score, their difference.  Texts without a word have no symbols and
    score 0; null ids are never a target."""
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.lit(0).alias("role"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, ranges = 1 + size // BLOCK, 1 + size // RANGE
    marks = good.select(F.col(id_col).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text"),
                        F.lit(1).alias("role")).filter("doc_id is not null").distinct()
    # A null id is no target's, so its text says where it goes.
    dealt = d.unionByName(marks).withColumn("block", F.pmod(
        F.coalesce(F.xxhash64(F.lit(3), F.when(F.col("doc_id").isNull(), F.col("text")), "doc_id"), F.lit(0)),
        F.lit(blocks)).cast("int"))
    asked = dealt.groupBy("block").applyInPandas(ask(ranges), ASKED)
    told = written(asked.groupBy("range").applyInPandas(tell, TOLD), "lm-counts")
    v, n, t = told.agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in ("v", "n", "t")]).first()  # three numbers
    return (dealt.groupBy("block").cogroup(told.select("block", "range", "counts").groupBy("block"))
            .applyInPandas(losses(ranges, v, (n, t)), SCORED)
            .withColumn("score", F.col("target_loss") - F.col("background_loss")))
