"""Cross-entropy difference scoring.

Two character n-gram models of one vocabulary, order and smoothing are counted
over the whole corpus: one of the target documents, one of the background (all
documents).  A document's score is the mean over its symbols of the target
model's loss minus the background model's; low is like the target.

The vocabulary is ``SYMBOLS`` classes of UTF-8 bytes, so a model of order
``ORDER`` has at most 32**4 counts: that bounds what is gathered, broadcast
and held, whatever the size of the corpus.  Counts are exact, over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS, ORDER = 32, 4
CELLS = SYMBOLS ** ORDER


def symbol_table() -> np.ndarray:
    """Byte -> class: 0 start and line feed, 1 other white space and controls,
    2 digits, 3 other ASCII, 4 lead and 5 continuation bytes beyond ASCII,
    6 to 31 the letters without case."""
    t = np.full(256, 3, np.int32)
    t[:33] = 1
    t[10] = 0
    t[48:58] = 2
    t[0xC0:] = 4
    t[0x80:0xC0] = 5
    for i in range(26):
        t[65 + i] = t[97 + i] = 6 + i
    return t


TABLE = symbol_table()


def grams(raw: bytes) -> np.ndarray:
    """Codes of the windows that end at each byte, the text led in by starts."""
    s = TABLE[np.frombuffer(b"\n" * (ORDER - 1) + raw, np.uint8)]
    n = len(raw)
    code = np.zeros(n, np.int32)
    for i in range(ORDER):
        code = code * SYMBOLS + s[i:i + n]
    return code


def losses(counts: np.ndarray) -> np.ndarray:
    """-ln p(last | the others) per cell: Witten-Bell interpolation of orders
    ``ORDER`` to 1 with the uniform distribution.  Contexts never seen fall
    back whole; an empty model is uniform."""
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for order in range(1, ORDER + 1):
        # Counts of the last ``order`` symbols, as context x symbol.
        c = counts.reshape(-1, SYMBOLS ** order).sum(0).reshape(-1, SYMBOLS).astype(np.float64)
        total, kinds = c.sum(1, keepdims=True), (c > 0).sum(1, keepdims=True)
        lower = np.tile(p, (len(c) // max(1, len(p) // SYMBOLS), 1)).reshape(len(c), SYMBOLS) if order > 1 \
            else p.reshape(1, SYMBOLS)
        p = np.where(total > 0, (c + kinds * lower) / np.maximum(total + kinds, 1), lower).reshape(-1)
    return -np.log(p)


def corpus_counts(docs: DataFrame, text: str, target: str) -> tuple[np.ndarray, np.ndarray]:
    """(target, background) counts per cell over all of ``docs``; ``target`` is
    a boolean column.  Tasks hand over the cells they saw, Spark adds them up,
    and at most ``CELLS`` rows reach the driver, as Arrow."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, CELLS), np.int64)
        waiting: list[list[np.ndarray]] = [[], []]

        def flush(k):
            if waiting[k]:
                sums[k] += np.bincount(np.concatenate(waiting[k]), minlength=CELLS)
                waiting[k].clear()

        held = [0, 0]
        for pdf in batches:
            for t, hit in zip(pdf["text"].tolist(), pdf["hit"].tolist()):
                if t:
                    k = int(bool(hit))
                    waiting[k].append(grams(t.encode("utf-8", "surrogatepass")))
                    held[k] += len(waiting[k][-1])
                    if held[k] > 4_000_000:
                        flush(k)
                        held[k] = 0
        flush(0)
        flush(1)
        seen = np.flatnonzero(sums.any(0))
        yield pd.DataFrame({"cell": seen, "t": sums[1, seen], "b": sums[0, seen] + sums[1, seen]})

    got = (docs.select(F.col(text).alias("text"), F.coalesce(F.col(target), F.lit(False)).alias("hit"))
           .mapInPandas(count, "cell int, t bigint, b bigint")
           .groupBy("cell").agg(F.sum("t").alias("t"), F.sum("b").alias("b")).toPandas())
    out = np.zeros((2, CELLS), np.int64)
    out[0, got["cell"]], out[1, got["cell"]] = got["t"], got["b"]
    return out[0], out[1]


def score(docs: DataFrame, counts: tuple[np.ndarray, np.ndarray], text: str = "text") -> DataFrame:
    """``docs`` with n_symbols, target_loss, background_loss (nats a symbol)
    and score, their difference, under the ``counts`` of ``corpus_counts``.
    Null and empty texts have no symbols and score 0; without a target document
    its model is uniform.  Columns of those names are replaced; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(map(losses, counts)))  # 8 MB each, at any size

    @F.pandas_udf("n bigint, t double, b double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lt, lb = shared.value
        for texts in batches:
            rows = np.zeros((len(texts), 3))
            for i, x in enumerate(texts.tolist()):
                if x:
                    g = grams(x.encode("utf-8", "surrogatepass"))
                    rows[i] = len(g), lt[g].mean(), lb[g].mean()
            yield pd.DataFrame({"n": rows[:, 0].astype("int64"), "t": rows[:, 1], "b": rows[:, 2]})

    tmp = "__lm"
    while tmp in docs.columns:
        tmp += "_"
    s: Column = F.col(tmp)
    return docs.withColumn(tmp, scored(F.col(text))).withColumns({
        "n_symbols": s["n"], "target_loss": s["t"], "background_loss": s["b"],
        "score": s["t"] - s["b"]}).drop(tmp)
