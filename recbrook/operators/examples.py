"""Training examples and vector operators over (id, embedding) frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import dot, sigmoid
from ..schemas import POST_DENSE_COLS, USER_DENSE_COLS


def embedding_lookup(keys: DataFrame, key: str, vectors: DataFrame, out: str = "embedding") -> DataFrame:
    """Attach the vector of ``key`` from an ``(id, embedding)`` frame (an
    equi-join; rows without a vector are dropped)."""
    v = vectors.select(F.col("id").alias(key), F.col("embedding").alias(out))
    return keys.join(v, key)


def scored_pairs(pairs: DataFrame, user_vecs: DataFrame, post_vecs: DataFrame) -> DataFrame:
    """``score`` = dot product of the user and post vectors for every
    (user_id, post_id) row, 0 where a side has no vector; label = weight > 0
    when a weight is present."""
    u = user_vecs.select(F.col("id").alias("user_id"), F.col("embedding").alias("_u"))
    p = post_vecs.select(F.col("id").alias("post_id"), F.col("embedding").alias("_p"))
    out = (pairs.join(u, "user_id", "left").join(p, "post_id", "left")
           .withColumn("score", F.coalesce(dot(F.col("_u"), F.col("_p")), F.lit(0.0))))
    if "weight" in pairs.columns:
        out = out.withColumn("label", (F.col("weight") > 0).cast("int"))
    return out.drop("_u", "_p")


def mean_pool(history: DataFrame, key: str, vec: str) -> DataFrame:
    """Element-wise mean of the vectors of each key, whatever their width:
    means per (key, position), aggregated map-side, so a hot key ships one
    row per position and task; then one array per key."""
    parts = history.select(key, F.posexplode(vec).alias("_i", "_v")).groupBy(key, "_i").agg(
        F.avg(F.col("_v").cast("double")).alias("_m"))
    return parts.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_i", "_m"))).alias("_p")).select(
        key, F.transform("_p", lambda s: s["_m"]).alias("pooled"))


def _zeros(width) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), width)


def training_examples(iwn: DataFrame, user_dense: DataFrame, post_dense: DataFrame,
                      user_vecs: DataFrame, post_vecs: DataFrame) -> DataFrame:
    """One row per interaction (negatives included) with both learned
    vectors, both scalar-feature vectors, the label and the weight, keyed
    by the interaction's own user and post ids.

    No row is lost: a side without a vector brings zeros and
    ``has_user_vector`` / ``has_post_vector`` 0 (the ranker's weights on these
    marks are the learned default); missing scalars are zeros too."""
    u = user_vecs.select(F.col("id").alias("user_id"), F.col("embedding").alias("user_embedding"))
    p = post_vecs.select(F.col("id").alias("post_id"), F.col("embedding").alias("post_embedding"))
    ud = user_dense.withColumnRenamed("uid", "user_id")
    pd_ = post_dense.withColumnRenamed("po_id", "post_id")
    wide = {n: F.coalesce(v.select(F.max(F.size("embedding")).alias("w")).scalar(), F.lit(0))
            for n, v in (("user", user_vecs), ("post", post_vecs))}
    # Each side's vectors and scalars are one row before they meet the interactions, of
    # which a few posts hold very many: one join a side, whose hot keys adaptive execution
    # splits (it leaves a second join on the same key alone), and the posts' join first,
    # while the rows are narrow.
    users, posts = u.join(ud, "user_id", "full"), p.join(pd_, "post_id", "full")
    return (iwn.select("user_id", "post_id", "interaction_type", "weight")
            .withColumn("label", (F.col("weight") > 0).cast("int"))
            .join(posts, "post_id", "left").join(users, "user_id", "left")
            .withColumns({
                "has_user_vector": F.col("user_embedding").isNotNull().cast("int"),
                "has_post_vector": F.col("post_embedding").isNotNull().cast("int"),
                "user_embedding": F.coalesce("user_embedding", _zeros(wide["user"])),
                "post_embedding": F.coalesce("post_embedding", _zeros(wide["post"])),
                "user_dense": F.coalesce("user_dense", _zeros(F.lit(len(USER_DENSE_COLS)))),
                "post_dense": F.coalesce("post_dense", _zeros(F.lit(len(POST_DENSE_COLS))))})
            .select("post_id", "user_id", "interaction_type", "weight", "label", "user_embedding", "user_dense",
                    "post_embedding", "post_dense", "has_user_vector", "has_post_vector"))


def content_vector(examples: DataFrame) -> DataFrame:
    """The ranking input: user vector, post vector, user scalars, post
    scalars, the two marks, concatenated in that order (float)."""
    marks = F.array(F.col("has_user_vector").cast("float"), F.col("has_post_vector").cast("float"))
    return examples.withColumn("features", F.concat(
        F.col("user_embedding"), F.col("post_embedding"),
        F.col("user_dense"), F.col("post_dense"), marks))


def with_texts_and_location(examples: DataFrame, users_encoded: DataFrame, posts_encoded: DataFrame,
                            locations: DataFrame) -> DataFrame:
    """Examples with the towers' inputs: the padded id arrays of the user's and
    the post's text columns and the user's location features (NULL for a user
    or post without a row)."""
    # The hot posts' join first, before the users' texts widen the rows; one join a side.
    users = users_encoded.join(locations, "uid", "full").withColumnRenamed("uid", "user_id")
    posts = posts_encoded.withColumnRenamed("po_id", "post_id")
    out = examples.join(posts, "post_id", "left").join(users, "user_id", "left")
    rest = [[c for c in df.columns if c not in ("user_id", "post_id")] for df in (examples, users, posts)]
    return out.select("post_id", "user_id", *rest[0], *rest[1], *rest[2])


def dot_probability(scored: DataFrame) -> DataFrame:
    return scored.withColumn("probability", sigmoid(F.col("score")))
