"""Feature tables: the stored procedure and loose statements as one lazy
DataFrame DAG (``build_features``), plus the transformation step.

Every per-user (per-post) aggregate is keyed on uid (po_id) and joined to
the user (post) table once; consecutive joins on the same key reuse one
hash partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import POST_DENSE_COLS
from ..session import ensure_checkpoint_dir
from ..sources import derived as D
from ..operators import clean, collabs, encode, geo, interactions as I, posts, scale, users as U


@dataclass
class Inputs:
    """The five recommender tables (lazy frames)."""
    users: DataFrame
    post_keys: DataFrame    # (po_id)
    post_bodies: DataFrame  # (po_id, description)
    post_titles: DataFrame  # (po_id, title)
    post_text: DataFrame    # (po_id, title, description)
    comments: DataFrame
    collabs: DataFrame
    interactions: DataFrame
    profile: DataFrame  # users' own columns only (no bio, no logins)
    bio: DataFrame      # (uid, bio) for users with a bio
    logins: DataFrame   # (uid, ts), a row per login

    @classmethod
    def load(cls, spark: SparkSession, sf_dir: str) -> "Inputs":
        return cls(D.users(spark, sf_dir), D.post_keys(spark, sf_dir), D.post_bodies(spark, sf_dir),
                   D.post_titles(spark, sf_dir), D.post_text(spark, sf_dir),
                   D.comments(spark, sf_dir), D.collabs(spark, sf_dir),
                   D.interactions(spark, sf_dir), D.user_profile(spark, sf_dir),
                   D.user_bio(spark, sf_dir), D.logins(spark, sf_dir))


def interactions_with_negatives(x: Inputs) -> DataFrame:
    return I.interactions_with_negatives(x.interactions, x.profile)


def user_table(x: Inputs, iwn: DataFrame | None = None) -> DataFrame:
    """Users with counts, login frequency, project and recent titles."""
    iwn = iwn if iwn is not None else interactions_with_negatives(x)
    return (x.users
            .join(U.login_frequency_by_user(x.logins), "uid", "left")
            .join(U.interaction_counts_by_user(x.interactions), "uid", "left")
            .na.fill(0, subset=list(U.COUNTED_TYPES))
            .join(collabs.project_titles_by_user(x.collabs), "uid", "left")
            .join(U.recent_titles_by_user(iwn, x.post_titles), "uid", "left"))


def user_numeric(x: Inputs) -> DataFrame:
    """(uid, login_frequency, viewed_posts, upvoted_posts, commented_posts):
    the ranking model's user scalars, without reading any user text."""
    return (U.login_frequency_of(x.profile, x.logins)
            .join(U.interaction_counts_by_user(x.interactions), "uid", "left")
            .na.fill(0, subset=list(U.COUNTED_TYPES)))


def post_table(x: Inputs) -> DataFrame:
    """Posts with comments, counts, mean view time and CTR."""
    return x.post_text.join(posts.comments_by_post(x.comments), "po_id", "left").join(
        post_numeric(x), "po_id", "left")


def post_numeric(x: Inputs) -> DataFrame:
    """(po_id, the ranking model's post scalars), without any post's
    comments or titles; documents are read once."""
    return posts.with_ctr(posts.post_features(x.post_bodies, x.interactions, x.comments),
                          I.fed_posts(x.profile), x.interactions)


def scaled_user_features(users: DataFrame) -> DataFrame:
    return scale.standard_scale(users, ["login_frequency"])


def scaled_post_features(post_tbl: DataFrame) -> DataFrame:
    """z-scored post features.  The narrow feature table is written once to
    the checkpoint folder: the fit and the transform both read it instead
    of recomputing the post joins."""
    ensure_checkpoint_dir(post_tbl.sparkSession)
    narrow = post_tbl.select("po_id", *POST_DENSE_COLS).checkpoint(eager=True)
    return scale.standard_scale(narrow, POST_DENSE_COLS)


def location_features(users: DataFrame) -> DataFrame:
    """(uid, lat, lon scaled, geo_rbf), from the points as the warehouse stores
    them; one that cannot be read counts as missing."""
    sp = geo.scaled_points(geo.decode_points(geo.encode_points(users)))
    return geo.geo_rbf(sp, geo.rbf_centers(sp))


def user_texts(x: Inputs, iwn: DataFrame | None = None) -> DataFrame:
    """``(uid, _col, text)`` for the four user text columns, each taken from
    its own source: no wide join carries long texts through a shuffle.
    Project titles are the leading ones that fill the encoded length.
    Every user has a ``passions`` row, so every uid is present."""
    iwn = iwn if iwn is not None else interactions_with_negatives(x)
    joined = lambda c: F.array_join(F.col(c), " ")
    return (x.profile.select("uid", F.lit("passions").alias("_col"),
                             F.coalesce(joined("passions"), F.lit("")).alias("text"))
            .unionByName(x.bio.select("uid", F.lit("bio").alias("_col"), F.col("bio").alias("text")))
            .unionByName(collabs.leading_titles(x.collabs, encode.USER_TEXT_LENGTHS["project_titles"] - 2)
                         .select("uid", F.lit("project_titles").alias("_col"), joined("project_titles").alias("text")))
            .unionByName(U.recent_titles_by_user(iwn, x.post_titles)
                         .select("uid", F.lit("recent_titles").alias("_col"), joined("recent_titles").alias("text"))))


def post_texts(x: Inputs) -> DataFrame:
    """``(po_id, _col, text)`` for title, description and comments, of which
    the leading ones that fill the encoded length."""
    com = posts.leading_comments(x.comments, encode.POST_TEXT_LENGTHS["comments"] - 2) \
        .join(x.post_keys, "po_id", "left_semi")
    return (x.post_bodies.select("po_id", F.lit("description").alias("_col"), F.col("description").alias("text"))
            .unionByName(x.post_titles.select("po_id", F.lit("title").alias("_col"), F.col("title").alias("text")))
            .unionByName(com.select("po_id", F.lit("comments").alias("_col"),
                                    F.array_join("comments", " ").alias("text"))))


def vocabulary(x: Inputs, iwn: DataFrame | None = None) -> DataFrame:
    """The corpus vocabulary over all seven text columns (empty texts add
    no tokens, so only present texts are read).  Comments and project
    titles are counted row by row, never gathered per post or user."""
    iwn = iwn if iwn is not None else interactions_with_negatives(x)
    keys = x.profile.select("uid")
    texts = [
        x.profile.select(F.array_join("passions", " ").alias("text")),
        x.bio.select(F.col("bio").alias("text")),
        collabs.member_titles(x.collabs).join(keys, "uid", "left_semi").select(F.col("title").alias("text")),
        U.recent_titles_by_user(iwn, x.post_titles).join(keys, "uid", "left_semi")
        .select(F.array_join("recent_titles", " ").alias("text")),
        x.post_titles.select(F.col("title").alias("text")),
        x.post_bodies.select(F.col("description").alias("text")),
        x.comments.join(x.post_keys, "po_id", "left_semi").select(F.col("content").alias("text")),
    ]
    return encode.build_vocabulary(reduce(DataFrame.unionByName, texts))


def encoded_users(x: Inputs, vocab: DataFrame, iwn: DataFrame | None = None) -> DataFrame:
    """Users with padded id arrays for the four user text columns."""
    return encode.pad(encode.encode_long(user_texts(x, iwn), "uid", encode.USER_TEXT_LENGTHS, vocab),
                      encode.USER_TEXT_LENGTHS)


def encoded_posts(x: Inputs, vocab: DataFrame) -> DataFrame:
    """Posts with padded id arrays for title, description and comments."""
    return encode.pad(encode.encode_long(post_texts(x), "po_id", encode.POST_TEXT_LENGTHS, vocab),
                      encode.POST_TEXT_LENGTHS)


def encoded_tables(x: Inputs, iwn: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vocabulary, users with padded id arrays, posts with padded id arrays).
    The vocabulary is materialised once and shared by both sides."""
    iwn = iwn if iwn is not None else interactions_with_negatives(x)
    ensure_checkpoint_dir(x.users.sparkSession)
    vocab = vocabulary(x, iwn).checkpoint(eager=True)
    return vocab, encoded_users(x, vocab, iwn), encoded_posts(x, vocab)


def build_features(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Everything the SQL procedure and the transformation step produce."""
    x = Inputs.load(spark, sf_dir)
    iwn = interactions_with_negatives(x)
    ut = user_table(x, iwn)
    pt = post_table(x)
    vocab, eu, ep = encoded_tables(x, iwn)
    return {
        "interactions": clean.clean_interactions(iwn),
        "users": scaled_user_features(ut),
        "posts": scaled_post_features(pt),
        "locations": location_features(x.profile),
        "vocabulary": vocab,
        "encoded_users": eu,
        "encoded_posts": ep,
    }


def dense_user_vector(user_tbl: DataFrame) -> DataFrame:
    """(uid, user_dense): 4 floats in model order, NULL imputed as 0.0."""
    from ..schemas import USER_DENSE_COLS
    sc = scaled_user_features(user_tbl)
    vec = F.array(*[F.coalesce(F.round(F.col(c).cast("double"), 6), F.lit(0.0)).cast("float")
                    for c in USER_DENSE_COLS])
    return sc.select("uid", vec.alias("user_dense"))


def dense_post_vector(post_tbl: DataFrame) -> DataFrame:
    """(po_id, post_dense): 7 scaled floats in model order, NULL as 0.0."""
    sc = scaled_post_features(post_tbl)
    vec = F.array(*[F.coalesce(F.round(F.col(c), 6), F.lit(0.0)).cast("float")
                    for c in POST_DENSE_COLS])
    return sc.select("po_id", vec.alias("post_dense"))
