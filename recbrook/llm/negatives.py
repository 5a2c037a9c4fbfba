"""Hard-negative mining over anchor-clustered shared lists.

Vectors are whole numbers (floor(256 x)) and a score is their inner product.
Anchors of one label are clustered by direction.  In each block of candidates a
cluster sorts the candidates once by an upper bound of their scores: with the
cluster's centre c and the widest angle B of a member to it, a candidate v
scores at most |u| |v| cos(max(0, angle(v, c) - B)) with any member u.  Every
member walks that one list and stops where the bound certifies that nothing
behind it can matter: its worst kept score is above the bound, or the bound is
below the least score it may take.

Two passes: the positives (candidates of the anchor's label), then the negatives
of each positive's window.  A block holds about ``BLOCK`` candidates and meets
at most about ``GROUP`` anchors at a time, so no task's work grows with a label, and a
block returns its best few per anchor and window, which are ranked once more.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType
from pyspark.sql.window import Window

from .common import written

BLOCK, GROUP, PART, STEP = 8192, 8192, 1024, 512
SCALE, KEEP = 256, 5
#: Bounds of the cluster model, which only steers the order: the anchors it is
#: fitted on, its centres, and the members aimed at per label and centre.
SAMPLE, CENTRES, MEMBERS = 4096, 256, 8


def whole(x: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(SCALE * x, -1e300, 1e300))


@F.pandas_udf(BinaryType())
def pack(vectors: pd.Series) -> pd.Series:
    """floor(256 x), as 4-byte floats where these are exact."""
    out = []
    for v in vectors:
        q = whole(np.asarray(v, np.float64))
        out.append(q.astype("<f4" if not len(q) or np.abs(q).max() <= 1 << 24 else "<f8").tobytes())
    return pd.Series(out)


def matrix(packed: pd.Series, dim: int) -> np.ndarray:
    return np.stack([np.frombuffer(b, "<f4" if len(b) == 4 * dim else "<f8").astype(np.float64) for b in packed])


def usable(df: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, x, copies): the distinct rows that take part."""
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), v.alias("x"))
    bad = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return (rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~bad)
            .withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
            .groupBy("vec_id", "label", "x").agg(F.count("*").alias("copies")))


def directions(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def centres_of(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means; the start is k rows evenly spaced in the given order."""
    x = directions(x)
    c = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(np.abs(total).sum(1, keepdims=True) > 0, directions(total), c)
    return c


class Lists:
    """A block's candidates in id order, and the walk over them."""

    def __init__(self, pdf: pd.DataFrame, dim: int):
        pdf = pdf.sort_values("vec_id", kind="stable")
        self.ids, self.labels = pdf["vec_id"].to_numpy(), pdf["label"].to_numpy()
        self.x = matrix(pdf["q"], dim)
        self.big = float(np.abs(self.x).max()) if self.x.size else 0.0
        self.unit, self.dim = directions(self.x) if dim else self.x, dim
        with np.errstate(over="ignore"):
            self.norm = np.linalg.norm(self.x, axis=1)
        self.span = 1 << max(1, len(pdf) - 1).bit_length()  # room for a place in a sort key

    def walk(self, u: np.ndarray, own: np.ndarray, take: np.ndarray, who: np.ndarray, low: np.ndarray, high: np.ndarray):
        """(ask, id, score) of the best ``KEEP`` candidates of ``take`` per ask:
        ask i is of member ``who[i]`` and takes scores from low[i] to high[i]."""
        rows = np.flatnonzero(take)
        if not len(rows) or not len(who):
            return np.empty(0, int), np.empty(0, np.int64), np.empty(0, np.int64)
        span = self.span
        exact = max(100, span) * max(1.0, self.big) * max(1.0, float(np.abs(u).max()) if u.size else 0) * max(1, self.dim) < 2 ** 53
        with np.errstate(over="ignore", invalid="ignore"):
            norm = np.linalg.norm(u, axis=1)
            bound = self.bounds(directions(u) if self.dim else u, norm, rows)
        order = np.argsort(-bound, kind="stable")
        rows, bound = rows[order], bound[order]
        if exact:
            x, m = self.x, u
        else:  # beyond 53 bits: exact integers
            x, m = (np.array([[int(e) for e in r] for r in z], object).reshape(z.shape) for z in (self.x, u))
        best = np.full((KEEP, len(who)), -np.inf, float if exact else object)
        live = np.arange(len(who))
        for s in range(0, len(rows), STEP):
            at = rows[s:s + STEP]
            score = x[at].dot(m[who[live]].T)
            if not exact:
                score = np.minimum(np.maximum(score, -2 ** 63), 2 ** 63 - 1)
            fits = (score >= low[live]) & (score <= high[live]) & (self.ids[at][:, None] != own[who[live]])
            key = np.where(fits, score * span + (span - 1 - at)[:, None], -np.inf)
            better = (key > best[0, live]).any(0)
            if better.any():
                both = np.concatenate([best[:, live[better]], key[:, better]])
                both = np.partition(both, -KEEP, 0) if exact else np.sort(both, 0)
                best[:, live[better]] = np.sort(both[-KEEP:], 0)
            if s + STEP >= len(rows):
                break
            with np.errstate(over="ignore", invalid="ignore"):
                top = norm[who[live]] * bound[s + STEP]
                top = top + np.abs(top) * 1e-9 + 1e-6
            done = np.array([b > -np.inf and b // span > t or lo > t for b, lo, t in zip(best[0, live], low[live], top)], bool)
            live = live[~done]
            if not len(live):
                break
        place, ask = np.nonzero(best > -np.inf)
        found = best[place, ask]
        score = np.array([int(k) // span for k in found], np.int64)
        index = np.array([span - 1 - int(k) % span for k in found], int)
        return ask, self.ids[index], score

    def bounds(self, unit: np.ndarray, norm: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The most a unit member scores with each of ``rows``."""
        if not self.dim:
            return np.zeros(len(rows))
        mean = unit.sum(0)
        if np.abs(mean).sum() < 1e-9:
            mean = unit[0]
        mean = directions(mean[None])[0]
        spread = np.arccos(np.clip((unit @ mean)[norm > 0], -1, 1)).max(initial=0.0)
        angle = np.arccos(np.clip(self.unit[rows] @ mean, -1, 1))
        # The slack covers rounding of arccos near 0, where it is worst.
        return self.norm[rows] * np.cos(np.maximum(0, angle - spread - 1e-6))


def walked(negatives: bool):
    """Cogrouped: a block's candidates and a group's anchors."""
    def run(cand: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(cand) and len(anchors):
            for dim, members in anchors.groupby("dim"):
                mine = cand[cand["dim"] == dim]
                if not len(mine):
                    continue
                lists = Lists(mine, dim)
                for (label, _, _), part in members.sort_values("anchor_id").groupby(["label", "centre", "part"]):
                    u, own = matrix(part["q"], dim), part["anchor_id"].to_numpy()
                    if negatives:
                        asked = [(i, p, int(s)) for i, ss in enumerate(part["scores"]) for p, s in enumerate(ss, 1) if s >= 0]
                        who, rank, high = (np.array(z) for z in zip(*asked)) if asked else (np.empty(0, int),) * 3
                        low = np.array([-(-80 * s // 100) for _, _, s in asked], object if high.dtype == object else float)
                        take = lists.labels != label
                    else:
                        who, rank = np.arange(len(part)), np.zeros(len(part), int)
                        low, high = np.full(len(part), -np.inf), np.full(len(part), np.inf)
                        take = lists.labels == label
                    ask, ids, score = lists.walk(u, own, take, who, low, high)
                    if len(ask):
                        out.append(pd.DataFrame({"anchor_id": own[who[ask]], "p": rank[ask], "id": ids, "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"anchor_id": [], "p": [], "id": [], "score": []}, dtype="int64")
    return run


def ranked(found: DataFrame, *by: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= KEEP)


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are rows whose id is divisible by 100; their positives the first
    ``KEEP`` other rows of the label by score, ties by smaller id; for each the
    first ``KEEP`` rows of other labels scoring 80 to 100 % of it.  Where 7
    divides an id the label first becomes (label + 1) % 10.  Rows with a null
    id or label, a null vector, or a component that is null or not finite take
    no part; vectors of different length never meet.  Repeated rows are
    candidates each time; of an anchor's rows that differ the smallest label,
    then vector, stands; "other" is another id.  Scores are exact whole numbers,
    held to 64 bits.  Other columns are not read; no anchors, or none with a
    positive, give no rows.
    """
    rows = written(usable(df, id_col, vector, label)
                   .select("vec_id", "label", F.size("x").alias("dim"), pack("x").alias("q"), "x", "copies"), "negative-rows")
    anchors = rows.filter("vec_id % 100 = 0").groupBy(F.col("vec_id").alias("anchor_id")) \
        .agg(F.min(F.struct("label", "x", "dim", "q")).alias("a")).select("anchor_id", "a.*")
    anchors = written(anchors, "negative-anchors")
    n, labels, held = (*anchors.agg(F.count("*"), F.count_distinct("label")).first(), rows.count())
    sample = anchors.orderBy(F.xxhash64("anchor_id"), "anchor_id").limit(SAMPLE).select("dim", "x").toPandas()
    dim = int(sample["dim"].mode()[0]) if len(sample) else 0
    fit = sample[sample["dim"] == dim]
    centres = None
    if dim and len(fit):
        k = min(CENTRES, len(fit), max(1, round(n / (MEMBERS * labels))))
        centres = centres_of(whole(np.stack(fit["x"].to_numpy()).astype(np.float64)), k)

    @F.pandas_udf("int")
    def centre(packed: pd.Series) -> pd.Series:
        if centres is None:
            return pd.Series(np.zeros(len(packed), np.int32))
        return pd.Series([int((centres @ directions(matrix([b], dim))[0]).argmax()) if len(b) in (4 * dim, 8 * dim) else -1
                          for b in packed])

    blocks, groups = max(1, -(-held // BLOCK)), max(1, -(-n // GROUP))
    placed = anchors.select("anchor_id", "label", "dim", "q", centre("q").alias("centre"))
    parts = placed.groupBy("label", "centre").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    placed = written(placed.join(parts, ["label", "centre"])
                     .withColumn("part", F.pmod(F.xxhash64("anchor_id"), "parts").cast("int")).drop("parts")
                     .withColumn("g", F.pmod(F.xxhash64("label", "centre", "part"), F.lit(groups)).cast("int")), "negative-placed")
    # No list takes more of equal rows than it keeps.
    cand = (rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(KEEP)))))
            .select("vec_id", "label", "dim", "q", F.pmod(F.xxhash64("vec_id", "q", "copy"), F.lit(blocks)).cast("int").alias("block"))
            .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))

    def meet(asking: DataFrame, negatives: bool) -> DataFrame:
        spread = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return cand.groupBy("block", "g").cogroup(spread.groupBy("block", "g")).applyInPandas(
            walked(negatives), "anchor_id bigint, p int, id bigint, score bigint")

    positives = written(ranked(meet(placed, False), "anchor_id").select(
        "anchor_id", F.col("rank").alias("p"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
        "negative-positives")
    scores = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("p", "positive_score"))).alias("s")) \
        .select("anchor_id", F.col("s.positive_score").alias("scores"))  # KEEP at most
    found = ranked(meet(placed.join(scores, "anchor_id"), True), "anchor_id", "p")
    return found.join(positives, ["anchor_id", "p"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def negatives_sql() -> str:
    """DuckDB SQL of the rows over ``embeddings``, whose ids are distinct."""
    return """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same,
         CAST(list_inner_product(a.q, e.q) AS BIGINT) AS score
  FROM e AS a JOIN e ON a.vec_id <> e.vec_id AND len(a.q) = len(e.q) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5"""
