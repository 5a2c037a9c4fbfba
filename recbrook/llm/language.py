"""Language identification by string kernels.

A text is the set of its character n-grams of 1 to 3 code points (lower case;
everything that is no letter is a space), hashed to ``BINS`` presence bits.
The kernel of two texts is the size of their common set over the geometric
mean of their sizes.  A bounded sample of labelled texts is reduced to
landmarks (Nystroem), one-versus-rest ridge regression is solved in the
landmarks' space, and texts are scored in batches: presence matrix times
landmark matrix times class weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BINS = 1 << 14
ORDERS = 3
#: A document whose best language is nearer to chance than this has none.
MARGIN = 0.2


def gram_bins(text: str) -> np.ndarray:
    """Bins of the text's n-grams, with repeats.  Whole text, no prefix."""
    c = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    c[(c < 97) | (c > 122) & (c < 192)] = 32
    c *= np.uint32(0x9E3779B1)
    c ^= c >> np.uint32(15)
    parts, h = [], None
    for n in range(ORDERS):
        h = c.copy() if h is None else h[:-1] * np.uint32(0x85EBCA6B) + c[n:]
        m = h ^ (h >> np.uint32(13))
        m = m * np.uint32(0xC2B2AE35) + np.uint32(n)
        parts.append(m >> np.uint32(18))
    return np.concatenate(parts)


def presence(texts: list[str]) -> np.ndarray:
    x = np.zeros((len(texts), BINS), np.float32)
    for i, t in enumerate(texts):
        x[i, gram_bins(t)] = 1.0
    return x


class Model:
    """Landmark rows (presence scaled by their norm), class weights and bias."""

    def __init__(self, names: list[str], landmarks: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.names, self.landmarks, self.weights, self.bias = names, landmarks, weights, bias

    def scores(self, texts: list[str]) -> np.ndarray:
        x = presence(texts)
        k = (x @ self.landmarks.T).astype(np.float64) / np.sqrt(x.sum(1, keepdims=True))
        return k @ self.weights + self.bias


def train(packed: np.ndarray, labels: list[str], per_class: int = 40, ridge: float = 1e-4) -> Model | None:
    """``packed``: presence bits of the sample (``BINS`` / 8 bytes a row), in a
    fixed order; the first ``per_class`` rows of each class are its landmarks."""
    names = sorted(set(labels))
    if not names:
        return None

    def unit(bits: np.ndarray) -> np.ndarray:
        x = np.unpackbits(bits, axis=1).astype(np.float32)
        return x / np.sqrt(x.sum(1, keepdims=True))

    y = np.array([names.index(v) for v in labels])
    marks = np.concatenate([np.flatnonzero(y == c)[:per_class] for c in range(len(names))])
    land = unit(packed[marks])
    kmm = (land @ land.T).astype(np.float64)
    val, vec = np.linalg.eigh(kmm)
    good = val > 1e-6 * val.max()
    white = vec[:, good] / np.sqrt(val[good])
    z = np.concatenate([unit(packed[i:i + 128]) @ land.T for i in range(0, len(packed), 128)]).astype(np.float64) @ white
    mean = z.mean(0)
    z -= mean
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    weight = 1 / np.bincount(y, minlength=len(names))[y]  # classes count alike
    weight = (weight * len(y) / len(names))[:, None]
    base = (target * weight).sum(0) / weight.sum()
    g = z.T @ (z * weight) + ridge * len(y) * np.eye(z.shape[1])
    b = np.linalg.solve(g, z.T @ ((target - base) * weight))
    return Model(names, land, white @ b, base - mean @ b)


def fit(docs: DataFrame, usable, text: str = "text", lang: str = "lang", id_col: str = "doc_id",
        sample: int = 600, per_class: int = 40) -> Model | None:
    """Fit on at most ``sample`` rows per language of those ``usable`` is true
    for, picked by a hash of the id; only their presence bits (2 kB a row)
    reach the driver.  None without labelled rows."""
    have = docs.select(F.col(id_col).alias("i"), F.col(text).alias("t"), F.col(lang).cast("string").alias("l")) \
        .filter(usable & F.col("t").isNotNull() & F.col("l").isNotNull() & F.col("t").rlike(r"\p{L}"))
    counts = {r.l: r.n for r in have.groupBy("l").agg(F.count("*").alias("n")).collect()}  # a row per language
    if not counts:
        return None
    # Thin to some three times the sample before ranking, so ranking is small.
    span = 1 << 40
    keep = F.create_map(*[x for k, n in counts.items() for x in
                          (F.lit(k), F.lit(int(span * min(1.0, 3 * sample / n))))])
    thin = have.withColumn("h", F.xxhash64(F.lit(11), "i")).filter(F.pmod("h", F.lit(span)) < keep[F.col("l")])
    w = Window.partitionBy("l").orderBy("h", "i", F.xxhash64("t"))
    picked = thin.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= sample)

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return pd.Series([np.packbits(presence([t])[0] > 0).tobytes() for t in texts])

    rows = picked.select("l", "r", packed("t").alias("p")).toPandas().sort_values(["l", "r"])
    return train(np.frombuffer(b"".join(rows["p"]), np.uint8).reshape(len(rows), -1), rows["l"].tolist(), per_class)


def learnable(id_col: str = "doc_id"):
    """(usable for fitting, held out): by crc32 of the id as text, modulo 5."""
    rest = F.crc32(F.col(id_col).cast("string")) % 5
    return F.coalesce(rest != 0, F.lit(False)), F.coalesce(rest == 0, F.lit(False))


def least_score(model: Model) -> float:
    """The score from which a prediction stands: chance among the model's
    languages plus ``MARGIN`` of the rest (0.4 with four, 1 with one)."""
    chance = 1 / len(model.names)
    return chance + MARGIN * (1 - chance)


def predict(docs: DataFrame, model: Model | None, text: str = "text", lang_out: str = "lang_pred",
            score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1: softmax of
    four times the class scores).  Null text, and text without a letter, gives
    ``und`` and 0, and so does every row when there was nothing to learn from.
    Columns of those names are replaced; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(  # landmarks: 64 kB each, 40 a language
        model and (model.names, model.landmarks, model.weights, model.bias))

    @F.pandas_udf("lang string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m, letter = shared.value and Model(*shared.value), regex.compile(r"\p{L}").search
        for texts in batches:
            names, values = ["und"] * len(texts), np.zeros(len(texts))
            live = [i for i, t in enumerate(texts) if t and letter(t)] if m else []
            for s in range(0, len(live), 256):
                at = live[s:s + 256]
                z = 4 * m.scores([texts.iat[i] for i in at])
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                for i, c, v in zip(at, z.argmax(1), p.max(1)):
                    names[i], values[i] = m.names[c], v
            yield pd.DataFrame({"lang": names, "score": values})

    tmp = "__language"
    while tmp in docs.columns:
        tmp += "_"
    out = docs.withColumn(tmp, guess(F.col(text)))
    return out.withColumns({lang_out: F.col(tmp)["lang"], score_out: F.col(tmp)["score"]}).drop(tmp)
