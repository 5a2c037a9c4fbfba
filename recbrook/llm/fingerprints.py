"""Document fingerprints by a homomorphic multiset hash.

Each paragraph (a line of the text, as it stands) is hashed to a wide vector;
a document's fingerprint is the lane-wise sum of its paragraphs' vectors, so
it does not depend on their order, and inserting or deleting a paragraph adds
or subtracts one vector.  The vector has two parts:

* ``EXACT`` lanes modulo 2**32, from SHAKE-128 of the paragraph's bytes: equal
  exactly when the multisets of paragraphs are (up to collisions of 2,048 bits);
* ``SKETCH`` lanes modulo 2**32, signed sums over the paragraph's three-word
  windows: their cosine estimates how alike two documents are.

Null text counts as empty; an empty text is one empty paragraph.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_parts

EXACT, SKETCH = 64, 256


def fingerprint_lanes(paragraphs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The summed vectors (uint32 exact lanes, uint32 sketch lanes)."""
    exact = np.zeros(EXACT, np.uint32)
    words: list[int] = []
    for p in paragraphs:
        raw = p.encode("utf-8", "surrogatepass")
        exact += np.frombuffer(hashlib.shake_128(raw).digest(4 * EXACT), "<u4")
        words += (0, 0)
        words.extend(map(crc32, raw.split()))
    sketch = np.zeros(SKETCH, np.uint32)
    w = np.array(words, np.uint64)
    if len(w) > 2:
        h = w[2:] * np.uint64(0x9E3779B97F4A7C15) + w[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) \
            + w[:-2] * np.uint64(0x165667B19E3779F9)
        h = h[w[2:] != 0]  # windows end on a word, never on a paragraph's start marks
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h >>= np.uint64(40)
        lane = (h & np.uint64(SKETCH - 1)).astype(np.int64)
        sign = ((h >> np.uint64(8)) & np.uint64(1)).astype(np.float64) * 2 - 1
        sums = np.bincount(lane, sign, SKETCH)
        sketch += sums.astype(np.int64).astype(np.uint32)
    return exact, sketch


def add(x, y):
    return x[0] + y[0], x[1] + y[1]


def subtract(x, y):
    return x[0] - y[0], x[1] - y[1]


def encode(lanes) -> str:
    return base64.b64encode(lanes[0].astype("<u4").tobytes() + lanes[1].astype("<u4").tobytes()).decode()


def decode(text: str):
    raw = base64.b64decode(text)
    return np.frombuffer(raw, "<u4", EXACT).copy(), np.frombuffer(raw, "<u4", SKETCH, 4 * EXACT).copy()


def likeness(x, y) -> float:
    """1 for equal exact lanes, else the sketches' cosine held to 0..1."""
    if np.array_equal(x[0], y[0]):
        return 1.0
    a, b = x[1].view(np.int32).astype(np.float64), y[1].view(np.int32).astype(np.float64)
    n = np.sqrt((a @ a) * (b @ b))
    return float(min(1.0, max(0.0, a @ b / n))) if n else 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by the first as
    many of ``following`` (or all, where that is shorter)."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def edit_lanes(lanes, before: str, after: str):
    """The lanes of ``after`` from those of ``before``: only the paragraphs
    from the first that differs on are subtracted and added."""
    a, b = before.split("\n"), after.split("\n")
    same = 0
    for x, y in zip(a, b):
        if x != y:
            break
        same += 1
    return add(subtract(lanes, fingerprint_lanes(a[same:])), fingerprint_lanes(b[same:]))


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of its text column as a base64 string."""
    @F.pandas_udf("string")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([encode(fingerprint_lanes((t or "").split("\n"))) for t in texts])
    return df.withColumn(out, fp(F.coalesce(F.col(text), F.lit(""))))


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document in ascending id order: its fingerprint, its edited
    text's, and the likeness to that and to the next document's.

    Documents go to id ranges (bounds from approximate quantiles of the ids
    alone), texts shuffle once, and each range is read as a sorted stream; the
    first document of a range also goes to the range before it, so the stream
    needs one document at a time.  After the last comes the first.  Null ids
    come first; repeated ids are ordered by text; a single row is its own next.
    """
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = 4 * shuffle_parts(docs.sparkSession)
    bounds = np.unique(np.array(
        d.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.2 / ranges), np.int64))

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:  # how many bounds are at or below the id; 0 for null
        return pd.Series(np.where(ids.isna(), 0, np.searchsorted(bounds, ids.fillna(0).astype("int64"), "right")))

    # One row per range reaches the driver: the id at its head (null where it
    # has a null id) and, from that, the range that borrows it.
    heads = sorted((r.part, None if r.rows > r.ids else r.low) for r in
                   d.select("doc_id").withColumn("part", place("doc_id")).groupBy("part").agg(
                       F.count("doc_id").alias("ids"), F.count("*").alias("rows"),
                       F.min("doc_id").alias("low")).collect())
    lends = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}  # the last borrows the first's

    @F.pandas_udf("int")
    def lent_to(ids: pd.Series) -> pd.Series:
        return pd.Series([lends.get(None if pd.isna(x) else int(x), -1) for x in ids])

    copies = F.filter(F.array(F.struct(F.col("part"), F.lit(0).alias("lent")),
                              F.struct(F.col("lent_to").alias("part"), F.lit(1).alias("lent"))),
                      lambda s: s["part"] >= 0)
    rows = (d.withColumn("part", place("doc_id")).withColumn("lent_to", lent_to("doc_id"))
            .withColumn("at", F.explode(copies)).select("at.part", "at.lent", "doc_id", "text")
            .repartition("part").sortWithinPartitions("part", "lent", F.col("doc_id").asc_nulls_first(), "text"))

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, out = None, []  # held: part, id, text, lanes

        def emit(this, text, lanes):
            after = edited(this[2], text)
            new = edit_lanes(this[3], this[2], after)
            out.append((this[1], len(this[2]), hashlib.sha256(after.encode("utf-8", "surrogatepass")).hexdigest(),
                        encode(this[3]), encode(new), likeness(this[3], new), likeness(this[3], lanes)))

        for pdf in batches:
            for part, lent, doc_id, text in zip(pdf["part"], pdf["lent"], pdf["doc_id"], pdf["text"]):
                if lent and (held is None or held[0] != part):
                    continue  # a second row of a repeated id at the head of the next range
                lanes = fingerprint_lanes(text.split("\n"))
                if held is not None and held[0] == part:
                    emit(held, text, lanes)
                held = None if lent else (part, None if pd.isna(doc_id) else int(doc_id), text, lanes)
            if len(out) >= 512:
                yield frame(out)
                out.clear()
        if out:
            yield frame(out)

    def frame(rows_: list[tuple]) -> pd.DataFrame:
        f = pd.DataFrame(rows_, columns=NAMES)
        f["doc_id"] = f["doc_id"].astype("Int64")
        return f

    return rows.mapInPandas(stream, SCHEMA)


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")
