"""Embedding near-duplicates by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard
transform; the hash is the signed axis nearest to the result.  ``k`` such
hashes make a bucket of one table, and every vector also goes to the buckets
got by its second-nearest axis in its two least certain hashes (multiprobe).
Buckets are verified by blocked matrix products in double precision.

``k`` grows with the logarithm of the number of vectors, so random vectors
seldom share a bucket, and the number of tables follows from ``k`` by the miss
rate allowed for a pair just at the threshold.

Equal vectors are one class with a count.  A bucket of any size is cut into
chunks of about ``CHUNK`` classes, and each pair of chunks is one task's work,
so a bucket that holds a third of all vectors is neither one group nor emitted
as pairs: a group gives one row per vector with its number of links and one
edge per vector that spans the links.  A pair that meets in several buckets is
counted in the first of them, told from the codes both carry.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, written

PROBES, CHUNK = 4, 1024


def rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Three rounds of signs and the normalised Walsh-Hadamard transform;
    ``x`` is (n, d), d a power of two, ``signs`` (3, d)."""
    n, d = x.shape
    for s in signs:
        x = x * s
        h = 1
        while h < d:
            y = x.reshape(n, d // (2 * h), 2, h)
            x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], 2).reshape(n, d)
            h *= 2
        x = x / math.sqrt(d)
    return x


def codes(x: np.ndarray, k: int, tables: int, seed: int = 7) -> np.ndarray:
    """(n, tables * PROBES) bucket ids; bucket ids of different tables or
    widths do not meet (they are mixed with both)."""
    n, dim = x.shape
    d = max(2, 1 << (dim - 1).bit_length())
    x = np.concatenate([x, np.zeros((n, d - dim))], 1) if d > dim else x
    rng = np.random.default_rng([seed, d])
    out = np.empty((n, tables, PROBES), np.uint64)
    r = np.arange(n)
    for t in range(tables):
        first, second, gap = [], [], []
        for _ in range(k):
            y = rotate(x, rng.choice([-1.0, 1.0], size=(3, d)))
            a = np.abs(y)
            top = a.argmax(1)
            high = a[r, top]
            first.append(top * 2 + (y[r, top] < 0))
            a[r, top] = -1
            top = a.argmax(1)
            second.append(top * 2 + (y[r, top] < 0))
            gap.append(high - a[r, top])
        order = np.argsort(np.stack(gap, 1), 1, kind="stable")
        base, other = np.stack(first, 1), np.stack(second, 1)
        swaps = [(), (0,), (1,), (0, 1)] if k > 1 else [(), (0,), (), (0,)]
        for p, swap in enumerate(swaps):
            c = base.copy()
            for s in swap:
                c[r, order[:, s]] = other[r, order[:, s]]
            h = np.full(n, (t * 1_000_003 + dim) & 0xFFFFFFFF, np.uint64)
            for j in range(k):
                h = (h ^ c[:, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            out[:, t, p] = h
    return out.reshape(n, -1).view(np.int64)


def hit_rate(cosine: float, dim: int, k: int) -> float:
    """Share of pairs at just ``cosine`` that meet in a table (simulated, seeded)."""
    rng = np.random.default_rng(5)
    a = rng.normal(size=(400, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    o = rng.normal(size=(400, dim))
    o -= (o * a).sum(1, keepdims=True) * a
    n = np.linalg.norm(o, axis=1, keepdims=True)
    o = np.divide(o, n, out=np.zeros_like(o), where=n > 1e-12)
    b = cosine * a + math.sqrt(1 - cosine * cosine) * o
    ca, cb = (codes(x, k, 6).reshape(400, 6, PROBES) for x in (a, b))
    return float((ca[:, :, :, None] == cb[:, :, None, :]).any((2, 3)).mean())


def tables_for(cosine: float, dim: int, k: int, miss: float) -> int:
    p = min(0.999, max(0.01, hit_rate(cosine, dim, k)))
    return max(2, math.ceil(math.log(miss) / math.log(1 - p)))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _links(a: np.ndarray, b: np.ndarray, ca: np.ndarray, cb: np.ndarray, bucket: int, cosine: float,
           same: bool):
    """Index pairs with the cosine that have ``bucket`` as their first common code."""
    sim = a @ b.T >= cosine
    if same:
        sim = np.triu(sim, 1)
    i, j = np.nonzero(sim)
    if not len(i):
        return sim, i, j
    first = np.ones(len(i), bool)
    step = 1 << 18
    width = ca.shape[1]
    for s in range(0, len(i), step):
        x, y = ca[i[s:s + step]], cb[j[s:s + step]]
        met = np.zeros(len(x), bool)
        ok = np.zeros(len(x), bool)
        for t in range(0, width, PROBES):  # table by table, the first with a common bucket decides
            common = (x[:, t:t + PROBES, None] == y[:, None, t:t + PROBES]).any(2)
            at = common.any(1) & ~met
            lowest = np.where(common, x[:, t:t + PROBES], np.iinfo(np.int64).max).min(1)
            ok |= at & (lowest == bucket)
            met |= at
        first[s:s + step] = ok
    return sim, i[first], j[first]


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", cosine: float = 0.95,
                    miss: float = 1e-4) -> DataFrame:
    """One row per vector: vec_id, n_links (other rows linked directly),
    component_id (smallest id reachable, itself included), kept.

    Vectors that are null, empty or all zero, or hold a null, NaN or infinity,
    link with nothing and are kept; vectors of different length never link.
    Equal rows link with each other, and a null id is never the smallest
    unless all are null.
    """
    v = F.col(vector)
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), v.cast("array<double>").alias("x"))
    usable = (F.coalesce(F.size("x"), F.lit(0)) > 0) & ~F.exists(
        "x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) & F.exists("x", lambda e: e != 0.0)
    rows = rows.withColumn("key", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("x")))
    classes = written(rows.filter(F.col("key").isNotNull()).groupBy("key", "x")
                      .agg(F.count("*").alias("copies")), "embedding-classes")
    n, dim = classes.agg(F.count("*"), F.max(F.size("x"))).first()
    dim = dim or 2
    k = max(1, math.ceil(math.log(8 * max(n, 2)) / math.log(2 * max(2, 1 << (dim - 1).bit_length()))))
    tables = tables_for(cosine, dim, k, miss)

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for d, part in pdf.groupby(pdf["x"].map(len)):
                for s in range(0, len(part), 1024):
                    p = part.iloc[s:s + 1024]
                    u = unit(np.array(p["x"].tolist(), np.float64).reshape(len(p), d))
                    c = codes(u, k, tables)
                    yield pd.DataFrame({"key": p["key"].to_numpy(), "copies": p["copies"].to_numpy(),
                                        "v": [r.tobytes() for r in u], "codes": list(c)})

    coded = written(classes.mapInPandas(code, "key bigint, copies bigint, v binary, codes array<bigint>"),
                    "embedding-codes")
    slim = coded.select("key", F.explode(F.array_distinct("codes")).alias("bucket"))
    shared = (slim.groupBy("bucket").agg(F.count("*").alias("held")).filter("held > 1")
              .withColumn("chunks", F.ceil(F.col("held") / CHUNK).cast("int")))
    # Only buckets with company carry vectors; a large one goes as chunk pairs.
    mine = F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int")
    meet = (slim.join(shared, "bucket").withColumn("mine", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("key", "bucket", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
                    (F.col("mine") > F.col("other")).cast("int").alias("side"))
            .join(coded, "key")
            .repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "side", "key"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry: pd.DataFrame | None = None
        for pdf in batches:
            pdf = pdf if carry is None else pd.concat([carry, pdf], ignore_index=True)
            g = pdf[["bucket", "lo", "hi"]].to_numpy()
            cut = np.flatnonzero((g[1:] != g[:-1]).any(1)) + 1
            if not len(cut):
                carry = pdf
                continue
            carry = pdf.iloc[cut[-1]:].reset_index(drop=True)
            yield from chunk_pairs(pdf.iloc[:cut[-1]], np.concatenate([[0], cut]))
        if carry is not None and len(carry):
            yield from chunk_pairs(carry, np.array([0, len(carry)]))

    def chunk_pairs(pdf: pd.DataFrame, cut: np.ndarray) -> Iterator[pd.DataFrame]:
        keys, copies = pdf["key"].to_numpy(), pdf["copies"].to_numpy()
        side, bucket, vs = pdf["side"].to_numpy(), pdf["bucket"].to_numpy(), pdf["v"].to_numpy()
        lo, hi = pdf["lo"].to_numpy(), pdf["hi"].to_numpy()
        code_col = pdf["codes"].to_numpy()
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for s, e in zip(cut[:-1], cut[1:]):
            if e - s < 2:
                continue
            width = len(vs[s])
            if any(len(x) != width for x in vs[s:e]):
                continue  # different lengths met by a collision of hashes
            x = np.frombuffer(b"".join(vs[s:e])).reshape(e - s, -1)
            c = np.stack(code_col[s:e])
            same = lo[s] == hi[s]
            m = e - s if same else int((side[s:e] == 0).sum())
            a, b, ca, cb, off = (x, x, c, c, 0) if same else (x[:m], x[m:], c[:m], c[m:], m)
            if not len(b):
                continue
            sim, i, j = _links(a, b, ca, cb, bucket[s], cosine, same)
            if not sim.any():
                continue
            add = np.bincount(i, copies[s:e][j + off], e - s) + np.bincount(j + off, copies[s:e][i], e - s)
            # Labels by lowest linked neighbour until they stay: each vector's label spans the links.
            label = np.arange(e - s)
            while True:
                up = np.where(sim, label[:m, None], e).min(0)
                new = label.copy()
                new[off:off + len(b)] = np.minimum(new[off:off + len(b)], up)
                new[:m] = np.minimum(new[:m], np.where(sim, new[None, off:off + len(b)], e).min(1))
                new = np.minimum(new, new[new])
                if (new == label).all():
                    break
                label = new
            used = (add > 0) | (label != np.arange(e - s))
            out.append((keys[s:e][used], add[used].astype(np.int64), keys[s:e][label][used]))
        if out:
            yield pd.DataFrame({"key": np.concatenate([o[0] for o in out]),
                                "links": np.concatenate([o[1] for o in out]),
                                "to": np.concatenate([o[2] for o in out])})

    found = written(meet.mapInPandas(verify, "key bigint, links bigint, to bigint"), "embedding-links")
    linked = found.groupBy("key").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("key").alias("a"), F.col("to").alias("b")))
    of = (classes.select("key", "copies").join(linked, "key", "left")
          .join(comp.select(F.col("id").alias("key"), F.col("component").alias("root")), "key", "left")
          .select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                  F.coalesce("root", "key").alias("root")))
    ids = rows.select("vec_id", "key").join(of, "key", "left")
    lowest = ids.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("vec_id").alias("low"))
    return (ids.join(lowest, "root", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                    F.coalesce("low", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
