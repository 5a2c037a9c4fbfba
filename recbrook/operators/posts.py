"""Post operators: comments, counts, mean view time, CTR.

Counts that the warehouse computes as ``ARRAY_LENGTH`` of per-post arrays
are computed here by aggregating interactions directly.  The arrays are
built from exactly those interaction rows, so the numbers are the same, but
no per-post array is ever materialised: the aggregation is partial on the
map side, so a post holding a third of all interactions costs one
partial-count row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import ordered_values
from ..functions.text import tokenize


def post_comments(post_keys: DataFrame, comments: DataFrame) -> DataFrame:
    """``ARRAY_AGG(content)`` per post in turn order; NULL for none."""
    return post_keys.select("po_id").join(comments_by_post(comments), "po_id", "left")


def comments_by_post(comments: DataFrame) -> DataFrame:
    """(po_id, comments) for posts that have one."""
    return (comments.groupBy("po_id")
            .agg(F.sort_array(F.collect_list(F.struct("turn", "content"))).alias("_c"))
            .select("po_id", ordered_values(F.col("_c"), "content").alias("comments")))


def leading_comments(comments: DataFrame, tokens: int) -> DataFrame:
    """(po_id, comments): a post's first ``tokens`` comments, in turn order,
    that have a token, which hold the first ``tokens`` tokens of all its
    comments, so no post's comments are collected whole."""
    w = Window.partitionBy("po_id").orderBy("turn", "content")
    first = (comments.filter(F.size(tokenize(F.col("content"))) > 0)
             .withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= tokens))
    return (first.groupBy("po_id").agg(F.sort_array(F.collect_list(F.struct("_n", "content"))).alias("_c"))
            .select("po_id", ordered_values(F.col("_c"), "content").alias("comments")))


def post_engagement(interactions: DataFrame) -> DataFrame:
    """One conditional aggregate per post: the counts behind the
    ``upvotes``/``downvotes`` columns and the vote, view and view-length
    arrays."""
    t = F.col("interaction_type")
    is_view = t == "view"
    return interactions.groupBy(F.col("post_id").alias("po_id")).agg(
        F.count(F.when(t == "upvote", 1)).alias("upvotes"),
        F.count(F.when(t == "error", 1)).alias("downvotes"),
        F.count(F.when(t.isin("upvote", "error"), F.col("user_id"))).alias("vote_count"),
        F.count(F.when(is_view, F.col("user_id"))).alias("view_count"),
        F.count(F.when(is_view, 1)).alias("n_view_lengths"),
        F.sum(F.when(is_view, F.col("view_duration_secs"))).alias("view_seconds"),
    )


def post_features(post_text: DataFrame, interactions: DataFrame, comments: DataFrame) -> DataFrame:
    """post_length, vote_count, upvote_count, view_count, comment_count,
    avg_time_viewed.  Posts without interactions keep NULL counts (the
    arrays are NULL there); ``avg_time_viewed`` is 0 without views."""
    eng = post_engagement(interactions)
    com = comments.groupBy("po_id").agg(F.count("*").alias("comment_count"))
    n = F.col("n_view_lengths")
    # The length is taken before the joins: no description is shuffled or sorted.
    return (post_text.select("po_id", F.length("description").cast("bigint").alias("post_length"))
            .join(eng, "po_id", "left")
            .join(com, "po_id", "left")
            .select(
                "po_id",
                "post_length",
                "vote_count",
                (F.col("upvotes") - F.col("downvotes")).alias("upvote_count"),
                "view_count",
                "comment_count",
                F.when(n > 0, F.col("view_seconds") / n).otherwise(F.lit(0.0))
                .alias("avg_time_viewed"),
            ))


def post_ctr(post_keys: DataFrame, fed: DataFrame, interactions: DataFrame) -> DataFrame:
    """Users fed the post / distinct viewers (the reference's "CTR"), and
    its inverse ``view_through_rate``.

    ``fed_users`` and ``viewers`` are 0 when absent (``COUNT`` of an empty
    subquery), so ``ctr`` is NULL for a never-viewed post and 0 for a post
    viewed but never fed.  Both distinct counts shuffle on the (post, user)
    pair first, so a hot post is spread over many tasks before its final
    count.
    """
    return with_ctr(post_keys.select("po_id"), fed, interactions).select(
        "po_id", "fed_users", "viewers", "ctr", "view_through_rate")


def with_ctr(posts: DataFrame, fed: DataFrame, interactions: DataFrame) -> DataFrame:
    """``posts`` with the columns of ``post_ctr``."""
    fed_n = (fed.select(F.col("post_id").alias("po_id"), "user_id").distinct()
             .groupBy("po_id").agg(F.count("*").alias("fed_users")))
    viewers = (interactions.filter(F.col("interaction_type") == "view")
               .select(F.col("post_id").alias("po_id"), "user_id").distinct()
               .groupBy("po_id").agg(F.count("*").alias("viewers")))
    fed_users = F.coalesce(F.col("fed_users"), F.lit(0))
    n_viewers = F.coalesce(F.col("viewers"), F.lit(0))
    return (posts.join(fed_n, "po_id", "left").join(viewers, "po_id", "left")
            .withColumns({"fed_users": fed_users, "viewers": n_viewers})
            .withColumns({"ctr": F.try_divide("fed_users", "viewers"),
                          "view_through_rate": F.try_divide("viewers", "fed_users")}))
