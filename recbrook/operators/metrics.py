"""Model metrics: log loss, exact AUC, recall@k, in-batch retrieval loss."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import sigmoid
from .ordering import global_index, running_sum_before

# Probability clip of binary cross-entropy; retrieval batch size.
EPSILON = 1e-7
BATCH_SIZE = 256


def log_loss(scored: DataFrame, prob: str = "probability", label: str = "label") -> DataFrame:
    """Mean binary cross-entropy with p clipped to [eps, 1 - eps]: one
    global aggregate, partial per task."""
    p = F.least(F.greatest(F.col(prob), F.lit(EPSILON)), F.lit(1 - EPSILON))
    y = F.col(label).cast("double")
    bce = -(y * F.ln(p) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p))
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(bce).alias("log_loss"))


def auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Exact ROC AUC with ties counted one half:
    ``sum_s pos(s) * (neg(< s) + neg(s) / 2) / (P * N)``.

    Rows are first reduced to one row per distinct score (a partial
    aggregate, so one score shared by a third of all rows is one row);
    the count of negatives below each score then comes from a
    range-partitioned running sum, never a single-partition window.  NULL
    when either class is empty.
    """
    y = F.col(label)
    per_score = scored.groupBy(F.col(score).alias("s")).agg(
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(y == 1, 0).otherwise(1)).cast("bigint").alias("neg"))
    cum = running_sum_before(per_score, [F.col("s")], "neg", "neg_below")
    tot = cum.agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)).alias("_w"))
    return tot.select("n_pos", "n_neg", F.try_divide(
        F.col("_w"), F.col("n_pos").cast("double") * F.col("n_neg")).alias("auc"))


def recall_at_k(topk: DataFrame, user_labels: DataFrame, post_labels: DataFrame) -> DataFrame:
    """Share of a user's relevant posts (same label) found in its top k:
    ``(user_id, hits, relevant, recall)``.  Relevant counts come from a
    per-label count, so no (user, relevant post) pairs are formed."""
    per_label = post_labels.groupBy("label").agg(F.count(F.lit(1)).alias("relevant"))
    hits = (topk.select("user_id", "post_id")
            .join(post_labels.withColumnRenamed("label", "post_label"), "post_id")
            .join(user_labels, "user_id")
            .groupBy("user_id")
            .agg(F.count(F.when(F.col("post_label") == F.col("label"), 1)).alias("hits")))
    return (hits.join(user_labels, "user_id").join(per_label, "label", "left")
            .select("user_id", "hits", F.coalesce("relevant", F.lit(0)).alias("relevant"),
                    F.try_divide(F.col("hits"), F.col("relevant")).alias("recall")))


RETRIEVAL_LOSS_SCHEMA = ("batch long, n long, loss double, weighted_loss double, "
                         "reference_loss double")


def _batch_loss(pdf: pd.DataFrame) -> pd.DataFrame:
    """One batch: logits ``U P^T``, row-wise log-sum-exp minus the diagonal."""
    u = np.stack(pdf["u"].to_numpy()).astype(np.float64)
    p = np.stack(pdf["p"].to_numpy()).astype(np.float64)
    logits = u @ p.T
    m = logits.max(axis=1)
    ce = m + np.log(np.exp(logits - m[:, None]).sum(axis=1)) - np.einsum("ij,ij->i", u, p)
    w = pdf["weight"].to_numpy(dtype=np.float64)
    return pd.DataFrame({"batch": [int(pdf["batch"].iloc[0])], "n": [len(pdf)],
                         "loss": [float(ce.sum())], "weighted_loss": [float((w * ce).mean())],
                         "reference_loss": [float(w.mean() * ce.sum())]})


def retrieval_loss(positives: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """In-batch softmax loss of a retrieval model.

    ``positives`` holds (event_id, weight, u, p) with the user and post
    vectors of each positive pair.  Rows are put in batches of
    ``batch_size`` by event order (a distributed global index); inside a
    batch, row i's logits are ``u_i . p_j`` for every j, and its
    cross-entropy is ``logsumexp_j - u_i . p_i``.

    A batch is a group of at most ``batch_size`` rows by construction, so
    each is handed to numpy as one Arrow batch (``applyInPandas``) and
    scored with a single matrix product; no pair rows are formed.

    Per batch: ``loss`` (sum of cross-entropies, the default reduction),
    ``weighted_loss`` (mean of weight x cross-entropy) and
    ``reference_loss`` (mean weight x summed loss, the batch-level form).
    """
    idx = global_index(positives, [F.col("event_id")])
    b = idx.select(F.floor(F.col("idx") / batch_size).alias("batch"), "weight", "u", "p")
    return b.groupBy("batch").applyInPandas(_batch_loss, RETRIEVAL_LOSS_SCHEMA)


def probability(scored: DataFrame) -> DataFrame:
    return scored.withColumn("probability", sigmoid(F.col("score")))
