"""Document near-duplicates by ProbMinHash.

A document is its five-word shingles (lower case, words of letters and digits)
with their counts as weights.  Every shingle sends a Poisson process of
arrivals, at the rate of its weight, to the registers; a register keeps the
shingle that arrives first.  A shingle stops once its next arrival is later
than every register of the document holds.  Two documents share a register
with the probability Jaccard similarity of their weights, so banding the
registers finds candidates, and candidates are verified by that similarity,
computed exactly from their shingles.

Equal texts are one node.  In a bucket, candidates are links to its most
central node (the one that sits in the fullest buckets), one per member, never
all pairs; verified links make components, and only then are pairs tested that
share a bucket but are in different components, outsiders of a bucket's
largest component against its members.  So a group of copies of any size costs
about a link per copy, and every pair that shares a bucket is linked, tested or
below the similarity by its registers: four bits of each are carried along,
and pairs that agree in three standard deviations fewer registers than expected
at the similarity (variants of variants, or texts that share a passage) are left
out inside the join.  At just 0.8 that costs 0.1 % of pairs, banding 0.3 %; both
vanish above.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, written

WORDS, BANDS, ROWS, SIMILARITY = 5, 32, 8, 0.8
#: Bits of every register in a document's sketch, and how many standard
#: deviations below its mean the agreement of a pair may lie.
PLANES, SLACK = 4, 3.0
#: Members of one task's group around a central node.
CHUNK = 512
#: Bytes that are no letter or digit (beyond ASCII all count as letters) -> space.
_PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the text's shingles and their counts.  A text of fewer
    than five words is one shingle; one without words has none."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split()
    w = np.fromiter(map(crc32, raw), np.uint64, len(raw))
    n = max(len(w) - WORDS + 1, 1) if len(w) else 0
    h = np.zeros(n, np.uint64)
    for i in range(min(WORDS, len(w))):
        h = (h ^ w[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return np.unique(_mix(h), return_counts=True)


def signatures(docs: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """(documents, registers) hashes of the first arrivals, all documents at
    once: each round draws the next arrival of every shingle still running."""
    sizes = np.array([len(h) for h, _ in docs])
    doc = np.repeat(np.arange(len(docs)), sizes)
    item = np.concatenate([h for h, _ in docs]) if docs else np.zeros(0, np.uint64)
    rate = np.concatenate([c for _, c in docs]).astype(np.float64) if docs else np.zeros(0)
    first = np.full(len(docs) * registers, np.inf)
    who = np.zeros(len(docs) * registers, np.uint64)
    time = np.zeros(len(item))
    state = item.copy()
    latest = np.full(len(docs), np.inf)
    who_item = item
    while len(doc):
        state = state + np.uint64(0x9E3779B97F4A7C15)
        draw = _mix(state)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / rate
        go = time < latest[doc]
        doc, time, state, rate, who_item = doc[go], time[go], state[go], rate[go], who_item[go]
        if not len(doc):
            break
        at = doc * registers + (_mix(draw[go] ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, at, time)
        won = first[at] == time
        who[at[won]] = who_item[won]
        live = np.unique(doc)
        latest[live] = first.reshape(-1, registers)[live].max(1)
    return who.reshape(len(docs), registers)


def band_codes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents, bands) bucket ids, different bands in different id ranges."""
    out = np.empty((len(sig), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sig), b + 1, np.uint64)
        for r in range(rows):
            h = _mix((h ^ sig[:, b * rows + r]) * np.uint64(0x9E3779B97F4A7C15))
        out[:, b] = h
    return out.view(np.int64)


def probability_jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over common items d of 1 / sum over all items e of
    max(x_e / x_d, y_e / y_d); for equal weights the plain Jaccard similarity."""
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    if x[1].max() == y[1].max() == 1:
        return len(i) / (len(x[0]) + len(y[0]) - len(i))
    # Items with the same pair of weights count alike.
    ones = np.ones(len(x[1]), bool)
    ones[i] = False
    other = np.ones(len(y[1]), bool)
    other[j] = False
    xs = np.concatenate([x[1][i], x[1][ones], np.zeros(other.sum(), np.int64)])
    ys = np.concatenate([y[1][j], np.zeros(ones.sum(), np.int64), y[1][other]])
    pairs, counts = np.unique(np.stack([xs, ys], 1), axis=0, return_counts=True)
    a, b = pairs[:, 0].astype(float), pairs[:, 1].astype(float)
    both = (a > 0) & (b > 0)
    return float(sum(c / (counts * np.maximum(a / p, b / q)).sum() for p, q, c in zip(a[both], b[both], counts[both])))


def bit_sketch(sig: np.ndarray) -> np.ndarray:
    """(documents, PLANES * registers / 64) words: bit 17 of every register,
    then bit 18, ..."""
    planes = [((sig >> np.uint64(17 + p)) & np.uint64(1)).astype(np.uint8) for p in range(PLANES)]
    return np.packbits(np.concatenate(planes, 1), axis=1).view(">i8").astype(np.int64)


def agreeing(similarity: float):
    """Join condition: the sketches x and y agree in enough registers."""
    n, p = BANDS * ROWS, similarity + (1 - similarity) / 2 ** PLANES
    least = int(n * p - SLACK * (n * p * (1 - p)) ** 0.5)
    words = n // 64
    differ = [" | ".join(f"(x[{w + q * words}] ^ y[{w + q * words}])" for q in range(PLANES)) for w in range(words)]
    return F.expr(" + ".join(f"bit_count({d})" for d in differ) + f" <= {n - least}")


def _coded(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc_id, key, row, bands, bits) per document; null but for the first and
    third for null text."""

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bands, bits = np.empty(len(pdf), object), np.empty(len(pdf), object)
            held, at, total = [], [], 0

            def flush():
                if held:
                    sig = signatures(held, BANDS * ROWS)
                    for k, c, b in zip(at, band_codes(sig, BANDS, ROWS), bit_sketch(sig)):
                        bands[k], bits[k] = c, b
                    held.clear()
                    at.clear()

            for k, t in enumerate(pdf["text"].tolist()):
                if t is None:
                    continue
                s = shingles(t)
                if not len(s[0]):
                    bands[k] = np.zeros(0, np.int64)
                    continue
                held.append(s)
                at.append(k)
                total += len(s[0])
                if total > 300_000:
                    flush()
                    total = 0
            flush()
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "key": pdf["key"].astype("Int64"),
                                "row": pdf["row"], "bands": bands, "bits": bits})

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_key(F.col(text)).alias("key"),
                       F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    return written(rows.mapInPandas(code, "doc_id bigint, key bigint, row bigint, bands array<bigint>, "
                                   "bits array<bigint>"), "minhash-bands")


def text_key(text):
    """64-bit hash of the whole text; null for null."""
    return F.when(text.isNotNull(), F.xxhash64(text))


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose texts have the similarity.  ``a`` is
    the node with many partners: its text goes to each chunk of them once."""
    chunks = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    member = (pairs.join(chunks, "a").withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int"))
              .join(texts.withColumnRenamed("key", "b"), "b").select("a", "chunk", F.lit(1).alias("side"), "b", "text"))
    centre = (chunks.join(texts.withColumnRenamed("key", "a"), "a")
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .select("a", "chunk", F.lit(0).alias("side"), F.col("a").alias("b"), "text"))
    rows = centre.unionByName(member).repartition("a", "chunk").sortWithinPartitions("a", "chunk", "side")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, mine = None, None
        for pdf in batches:
            out = []
            for a, chunk, side, b, t in zip(pdf["a"], pdf["chunk"], pdf["side"], pdf["b"], pdf["text"]):
                if side == 0:
                    at, mine = (a, chunk), shingles(t)
                elif (a, chunk) == at and probability_jaccard(mine, shingles(t)) >= similarity - 1e-12:
                    out.append((a, b))
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return rows.mapInPandas(check, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                    similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, key (hash of its text), row, group_id
    (smallest doc_id of its group) and kept (true for one row of each group:
    the one of smallest doc_id, of repeated ones the first read).

    Null texts group with nothing and are kept.  Equal texts always group,
    empty ones too; other texts without a word group with nothing else.  A
    null doc_id comes after all others.
    """
    coded = _coded(docs, id_col, text)
    nodes = coded.filter("key is not null").select("key", "bands", "bits").dropDuplicates(["key"])
    slots = nodes.select("key", F.explode("bands").alias("bucket"))
    full = slots.groupBy("bucket").agg(F.count("*").alias("held")).filter("held > 1")
    shared = written(slots.join(full, "bucket"), "minhash-slots")
    central = shared.groupBy("key").agg(F.sum("held").alias("weight"))
    members = written(shared.join(central.join(coded.select("key", "bits").dropDuplicates(["key"]), "key"), "key")
                      .select("bucket", "key", "weight", "bits"), "minhash-members")
    centres = members.groupBy("bucket").agg(F.max(F.struct("weight", "key", "bits")).alias("c")) \
        .select("bucket", F.col("c.key").alias("a"), F.col("c.bits").alias("x"))
    near = agreeing(similarity)
    other = members.select("bucket", F.col("key").alias("b"), F.col("bits").alias("y"))
    star = written(other.join(centres, (other["bucket"] == centres["bucket"]) & (F.col("a") != F.col("b")) & near)
                   .select("a", "b").distinct(), "minhash-star")

    # Only texts that share a bucket with another move, once.
    involved = shared.select("key").distinct()
    texts = written(docs.select(text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
                    .join(involved.hint("merge"), "key").dropDuplicates(["key"]), "minhash-texts")
    links = written(verified(star, texts, similarity), "minhash-links")
    parts = components(links)

    # Members of a bucket outside its largest component, against those of other components.
    placed = members.join(parts.withColumnRenamed("id", "key"), "key", "left") \
        .select("bucket", "key", "bits", F.coalesce("component", "key").alias("part"))
    sizes = placed.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    major = sizes.groupBy("bucket").agg(F.max(F.struct("n", "part")).alias("m"), F.count("*").alias("parts")) \
        .filter("parts > 1").select("bucket", F.col("m.part").alias("major"))
    mixed = written(placed.join(major, "bucket").join(coded.select("key", "bands").dropDuplicates(["key"]), "key"),
                    "minhash-mixed")
    outside = mixed.filter("part <> major").select(
        F.col("bucket").alias("o_bucket"), F.col("key").alias("a"), F.col("part").alias("a_part"),
        F.col("bits").alias("x"), F.col("bands").alias("a_bands"))
    inside = mixed.select("bucket", F.col("key").alias("b"), "part", "major",
                          F.col("bits").alias("y"), F.col("bands").alias("b_bands"))
    # Of two outsiders the smaller key leads, and of the buckets that two share
    # (all of them mixed, as the two are in different components) the lowest counts.
    once = (F.col("part") == F.col("major")) | (F.col("a") < F.col("b"))
    lowest = F.array_min(F.array_intersect("a_bands", "b_bands")) == F.col("bucket")
    rest = outside.join(inside, (F.col("o_bucket") == F.col("bucket")) & (F.col("part") != F.col("a_part"))
                        & once & near & lowest).select("a", "b")
    tested = star.union(star.select("b", "a"))
    rest = written(rest.join(tested, ["a", "b"], "left_anti"), "minhash-rest")
    more = written(verified(rest, texts, similarity), "minhash-more")
    parts = components(links.unionByName(more))

    ids = coded.select("doc_id", "key", "row").join(parts.withColumnRenamed("id", "key"), "key", "left") \
        .withColumn("part", F.coalesce("component", "key"))
    # Written, so that both sides of the join below are plain shuffles, whose
    # oversized partitions (a large group's) adaptive execution splits.
    best = written(ids.filter("part is not null").groupBy("part").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best")), "minhash-best")
    return (ids.join(best, "part", "left")
            .select("doc_id", "key", "row", F.coalesce("best.doc_id", "doc_id").alias("group_id"),
                    F.coalesce(F.col("best.row") == F.col("row"), F.lit(True)).alias("kept")))
