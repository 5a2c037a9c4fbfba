"""Interaction operators: weights, fed pairs, negatives, append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Weight of each interaction type; anything else weighs 0.
INTERACTION_WEIGHTS = {"upvote": 2.0, "comment": 1.5, "view": 1.0}
NEGATIVE_TYPE = "no_interaction"


def filter_type(interactions: DataFrame, interaction_type: str) -> DataFrame:
    return interactions.filter(F.col("interaction_type") == interaction_type)


def interaction_weight(interactions: DataFrame) -> DataFrame:
    """``CASE type WHEN ... END`` weight; NULL and unknown types get 0.0."""
    t = F.col("interaction_type")
    w = None
    for name, weight in INTERACTION_WEIGHTS.items():
        w = F.when(t == name, weight) if w is None else w.when(t == name, weight)
    return interactions.withColumn("weight", w.otherwise(0.0).cast("double"))


def fed_posts(users: DataFrame) -> DataFrame:
    """One row per element of ``fed``: (user_id, post_id).  NULL and empty
    arrays contribute nothing; duplicates and NULL elements are kept."""
    return users.select(F.col("uid").alias("user_id"), F.explode("fed").alias("post_id"))


def fed_left_join(fed: DataFrame, interactions: DataFrame) -> DataFrame:
    """Every fed pair with its interactions, or NULLs when there are none."""
    return fed.join(interactions, ["user_id", "post_id"], "left")


def negative_samples(fed: DataFrame, interactions: DataFrame) -> DataFrame:
    """Fed pairs with no interaction on the same (user, post): an anti join
    that keeps duplicate fed pairs (it is not ``EXCEPT``).  The interaction
    side is reduced to distinct pairs first: a partial aggregate on the
    join keys, so repeats are dropped before the shuffle and the anti join
    reuses that partitioning."""
    seen = interactions.select("user_id", "post_id").distinct()
    return fed.join(seen, ["user_id", "post_id"], "left_anti")


def append_negatives(weighted: DataFrame, negatives: DataFrame) -> DataFrame:
    """``INSERT INTO interactions (user_id, post_id, interaction_type,
    weight) SELECT ...``: unlisted columns become NULL."""
    neg = negatives.select(
        "user_id", "post_id",
        F.lit(NEGATIVE_TYPE).alias("interaction_type"),
        F.lit(0.0).cast("double").alias("weight"))
    return weighted.unionByName(neg, allowMissingColumns=True)


def interactions_with_negatives(interactions: DataFrame, users: DataFrame) -> DataFrame:
    """Weighted interactions plus weight-0 negatives from fed posts."""
    weighted = interaction_weight(interactions)
    return append_negatives(weighted, negative_samples(fed_posts(users), interactions))
