"""Query registry: one entry per operator of the inventory.

Each query is ``(spark, sf_dir) -> DataFrame`` over the given tables, and
most carry DuckDB SQL that must give the same rows.  Floating results whose
summation order differs between engines are rounded to 6 places on both
sides.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import derived as D
from ..operators import collabs as C
from ..operators import interactions as I
from ..operators import posts as P
from ..operators import users as U
from .oracle import with_ctes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(c, 6)


# ---- scans -------------------------------------------------------------------
@query("scan_interactions", with_ctes("SELECT * FROM interactions", "interactions"))
def scan_interactions(spark, d):
    return D.interactions(spark, d)


@query("scan_comments", with_ctes("SELECT * FROM comments", "comments"))
def scan_comments(spark, d):
    return D.comments(spark, d)


@query("scan_posts", with_ctes("SELECT * FROM posts", "posts"))
def scan_posts(spark, d):
    return D.posts(spark, d)


@query("scan_collabs", with_ctes("SELECT * FROM collabs", "collabs"))
def scan_collabs(spark, d):
    return D.collabs(spark, d)


@query("scan_users", with_ctes(
    "SELECT * REPLACE (CAST(login_times AS VARCHAR[]) AS login_times) FROM users", "users"))
def scan_users(spark, d):
    """Login times as text, which both engines read back alike."""
    return D.users(spark, d).withColumn("login_times", F.col("login_times").cast("array<string>"))


@query("read_embeddings", with_ctes("SELECT * FROM vectors", "vectors"))
def read_embeddings(spark, d):
    return D.vectors(spark, d)


# ---- interactions ------------------------------------------------------------
@query("filter_views", with_ctes(
    "SELECT * FROM interactions WHERE interaction_type = 'view'", "interactions"))
def filter_views(spark, d):
    return I.filter_type(D.interactions(spark, d), "view")


@query("interaction_weight", with_ctes("SELECT * FROM weighted", "weighted"))
def interaction_weight(spark, d):
    return I.interaction_weight(D.interactions(spark, d))


@query("fed_posts", with_ctes("SELECT * FROM fed", "fed"))
def fed_posts(spark, d):
    return I.fed_posts(D.user_profile(spark, d))


@query("fed_left_join", with_ctes(
    "SELECT f.user_id, f.post_id, i.event_id, i.interaction_type, i.interaction_time, "
    "i.view_duration_secs, i.comment_length FROM fed f LEFT JOIN interactions i "
    "ON f.user_id = i.user_id AND f.post_id = i.post_id", "fed", "interactions"))
def fed_left_join(spark, d):
    return I.fed_left_join(I.fed_posts(D.user_profile(spark, d)), D.interactions(spark, d))


@query("negative_samples", with_ctes("SELECT * FROM negatives", "negatives"))
def negative_samples(spark, d):
    return I.negative_samples(I.fed_posts(D.user_profile(spark, d)), D.interactions(spark, d))


@query("append_negatives", with_ctes("SELECT * FROM iwn", "iwn"))
def append_negatives(spark, d):
    return I.interactions_with_negatives(D.interactions(spark, d), D.user_profile(spark, d))


# ---- collabs -----------------------------------------------------------------
@query("collab_members", with_ctes(
    "SELECT *, CASE WHEN team_uids IS NULL THEN NULL "
    "ELSE list_concat([owner_uid], team_uids) END AS all_team_uids FROM collabs", "collabs"))
def collab_members(spark, d):
    return C.collab_members(D.collabs(spark, d))


@query("user_project_titles", with_ctes("SELECT * FROM project_titles", "project_titles"))
def user_project_titles(spark, d):
    return C.user_project_titles(D.user_keys(spark, d), D.collabs(spark, d))


# ---- posts -------------------------------------------------------------------
@query("post_comments", with_ctes("SELECT * FROM post_comments", "post_comments"))
def post_comments(spark, d):
    return P.post_comments(D.post_keys(spark, d), D.comments(spark, d))


def _post_features(spark, d):
    return P.post_features(D.post_bodies(spark, d), D.interactions(spark, d), D.comments(spark, d))


@query("post_counts", with_ctes(
    "SELECT po_id, post_length, vote_count, upvote_count, view_count, comment_count "
    "FROM post_features", "post_features"))
def post_counts(spark, d):
    return _post_features(spark, d).drop("avg_time_viewed")


@query("post_avg_time_viewed", with_ctes(
    "SELECT po_id, round(avg_time_viewed, 6) AS avg_time_viewed FROM post_features",
    "post_features"))
def post_avg_time_viewed(spark, d):
    return _post_features(spark, d).select("po_id", r6(F.col("avg_time_viewed")).alias("avg_time_viewed"))


@query("post_ctr", with_ctes(
    "SELECT po_id, fed_users, viewers, round(ctr, 6) AS ctr, "
    "round(view_through_rate, 6) AS view_through_rate FROM post_ctr", "post_ctr"))
def post_ctr(spark, d):
    out = P.post_ctr(D.post_keys(spark, d), I.fed_posts(D.user_profile(spark, d)),
                     D.interactions(spark, d))
    return out.withColumn("ctr", r6(F.col("ctr"))).withColumn(
        "view_through_rate", r6(F.col("view_through_rate")))


# ---- users -------------------------------------------------------------------
@query("user_interaction_counts", with_ctes("SELECT * FROM user_counts", "user_counts"))
def user_interaction_counts(spark, d):
    return U.user_interaction_counts(D.user_keys(spark, d), D.interactions(spark, d))


@query("login_intervals", with_ctes("SELECT * FROM login_intervals", "login_intervals"))
def login_intervals(spark, d):
    return U.login_gaps(D.logins(spark, d).join(D.user_keys(spark, d), "uid", "left_semi"))


@query("user_login_frequency", with_ctes(
    "SELECT uid, round(login_frequency, 6) AS login_frequency FROM login_frequency",
    "login_frequency"))
def user_login_frequency(spark, d):
    out = U.login_frequency_of(D.user_keys(spark, d), D.logins(spark, d))
    return out.withColumn("login_frequency", r6(F.col("login_frequency")))


@query("user_recent_titles", with_ctes("SELECT * FROM recent_titles", "recent_titles"))
def user_recent_titles(spark, d):
    iwn = I.interactions_with_negatives(D.interactions(spark, d), D.user_profile(spark, d))
    return U.user_recent_titles(D.user_keys(spark, d), iwn, D.post_titles(spark, d))


# ---- feature tables ------------------------------------------------------------
from . import features as FT  # noqa: E402
from .oracle import POST_TEXT, USER_TEXT, scale_sql  # noqa: E402
from ..operators import clean as CL, encode as E, geo as G  # noqa: E402
from ..schemas import POST_DENSE_COLS  # noqa: E402


def _inputs(spark, d):
    return FT.Inputs.load(spark, d)


@query("user_features", with_ctes(
    "SELECT uid, viewed_posts, upvoted_posts, commented_posts, "
    "round(login_frequency, 6) AS login_frequency, project_titles, recent_titles FROM user_table",
    "user_table"))
def user_features(spark, d):
    ut = FT.user_table(_inputs(spark, d))
    return ut.select("uid", *U.COUNTED_TYPES, r6(F.col("login_frequency")).alias("login_frequency"),
                     "project_titles", "recent_titles")


@query("post_features", with_ctes(
    "SELECT po_id, post_length, vote_count, upvote_count, view_count, comment_count, "
    "round(avg_time_viewed, 6) AS avg_time_viewed, round(ctr, 6) AS ctr FROM post_table",
    "post_table"))
def post_features(spark, d):
    pt = FT.post_numeric(_inputs(spark, d))
    return pt.select("po_id", *POST_DENSE_COLS).withColumns(
        {"avg_time_viewed": r6(F.col("avg_time_viewed")), "ctr": r6(F.col("ctr"))})


# ---- cleaning ----------------------------------------------------------------
@query("interaction_time_parts", with_ctes("SELECT * FROM time_parts", "time_parts"))
def interaction_time_parts(spark, d):
    return CL.interaction_time_parts(FT.interactions_with_negatives(_inputs(spark, d)))


@query("clean_interactions", with_ctes(
    "SELECT event_id, user_id, post_id, coalesce(interaction_type, 'unknown') AS interaction_type, "
    "interaction_time, coalesce(view_duration_secs, 0.0) AS view_duration_secs, "
    "coalesce(comment_length, 0) AS comment_length, weight, coalesce(hour_of_day, 0) AS hour_of_day, "
    "coalesce(day_of_week, 0) AS day_of_week FROM time_parts", "time_parts"))
def clean_interactions(spark, d):
    return CL.clean_interactions(FT.interactions_with_negatives(_inputs(spark, d)))


@query("clean_users", with_ctes("SELECT * FROM clean_users", "clean_users"))
def clean_users(spark, d):
    cu = CL.clean_users(FT.user_table(_inputs(spark, d)))
    return cu.select("uid", *E.USER_TEXT_LENGTHS, *U.COUNTED_TYPES)


@query("clean_posts", with_ctes("SELECT * FROM clean_posts", "clean_posts"))
def clean_posts(spark, d):
    return CL.clean_posts(FT.post_table(_inputs(spark, d))).select(
        "po_id", *E.POST_TEXT_LENGTHS)


# ---- scaling -----------------------------------------------------------------
@query("scale_posts", with_ctes(scale_sql("post_table", "po_id", POST_DENSE_COLS, 6), "post_table"))
def scale_posts(spark, d):
    sc = FT.scaled_post_features(FT.post_numeric(_inputs(spark, d)))
    return sc.select("po_id", *[r6(F.col(c)).alias(c) for c in POST_DENSE_COLS])


@query("scale_users", with_ctes(scale_sql("login_frequency", "uid", ["login_frequency"], 6),
                                "login_frequency"))
def scale_users(spark, d):
    sc = FT.scaled_user_features(U.login_frequency_of(D.user_keys(spark, d), D.logins(spark, d)))
    return sc.select("uid", r6(F.col("login_frequency")).alias("login_frequency"))


@query("scale_geo", with_ctes(
    "SELECT uid, round(lat, 6) AS lat, round(lon, 6) AS lon FROM scaled_points", "scaled_points"))
def scale_geo(spark, d):
    sp = G.scaled_points(G.points(D.user_profile(spark, d)))
    return sp.select("uid", r6(F.col("lat")).alias("lat"), r6(F.col("lon")).alias("lon"))


# ---- geo ---------------------------------------------------------------------
@query("decode_points", with_ctes("SELECT uid, lon, lat FROM points", "points"))
def decode_points(spark, d):
    return G.decode_points(G.encode_points(D.user_profile(spark, d)))


@query("rbf_centers", with_ctes(
    "SELECT k, uid, round(lat, 6) AS lat, round(lon, 6) AS lon FROM rbf_centers", "rbf_centers"))
def rbf_centers(spark, d):
    sp = G.scaled_points(G.points(D.user_profile(spark, d)))
    return G.rbf_centers(sp).select("k", "uid", r6(F.col("lat")).alias("lat"),
                                    r6(F.col("lon")).alias("lon"))


@query("geo_rbf", with_ctes("SELECT * FROM geo_rbf", "geo_rbf"))
def geo_rbf(spark, d):
    lf = FT.location_features(D.user_profile(spark, d))
    return lf.select("uid", F.transform("geo_rbf", lambda v: F.round(v, 6)).alias("geo_rbf"))


# ---- text --------------------------------------------------------------------
@query("vocabulary", with_ctes("SELECT * FROM vocab", "vocab"))
def vocabulary(spark, d):
    return FT.vocabulary(_inputs(spark, d))


def _post_title_ids(spark, d):
    x = _inputs(spark, d)
    return E.encode(x.post_titles, "po_id", {"title": 10}, FT.vocabulary(x))


@query("encode_title", with_ctes("SELECT po_id, title FROM enc_posts", "enc_posts"))
def encode_title(spark, d):
    return _post_title_ids(spark, d)


@query("pad_title", with_ctes("SELECT po_id, title FROM padded_posts", "padded_posts"))
def pad_title(spark, d):
    return E.pad(_post_title_ids(spark, d), {"title": 10})


@query("token_width", with_ctes(
    "SELECT * FROM widths_users, widths_posts", "widths_users", "widths_posts"))
def token_width(spark, d):
    x = _inputs(spark, d)
    iwn = FT.interactions_with_negatives(x)
    wu = E.text_widths(FT.user_texts(x, iwn), "uid", E.USER_TEXT_LENGTHS)
    wp = E.text_widths(FT.post_texts(x), "po_id", E.POST_TEXT_LENGTHS)
    return wu.select(F.struct(*wu.columns).alias("u")).select(
        "u.*", *[wp.select(c).scalar().alias(c) for c in wp.columns])


@query("encode_users", with_ctes("SELECT * FROM padded_users", "padded_users"))
def encode_users(spark, d):
    x = _inputs(spark, d)
    iwn = FT.interactions_with_negatives(x)
    return FT.encoded_users(x, FT.vocabulary(x, iwn), iwn).select("uid", *USER_TEXT)


@query("encode_posts", with_ctes("SELECT * FROM padded_posts", "padded_posts"))
def encode_posts(spark, d):
    x = _inputs(spark, d)
    return FT.encoded_posts(x, FT.vocabulary(x)).select("po_id", *POST_TEXT)


# ---- vectors, examples, retrieval, metrics ---------------------------------------
from ..operators import examples as X, metrics as M, retrieval as R  # noqa: E402
from ..functions.vectors import dense, round_all  # noqa: E402


def _vecs(spark, d):
    return D.side_vectors(spark, d, "user"), D.side_vectors(spark, d, "post")


def _scored(spark, d):
    uv, pv = _vecs(spark, d)
    iwn = FT.interactions_with_negatives(_inputs(spark, d))
    return X.scored_pairs(iwn.select("user_id", "post_id", "interaction_type", "weight"), uv, pv)


@query("embedding_lookup", with_ctes(
    "SELECT k.uid, v.embedding FROM user_keys k JOIN uvec v ON v.id = k.uid", "user_keys", "uvec"))
def embedding_lookup(spark, d):
    return X.embedding_lookup(D.user_keys(spark, d), "uid", _vecs(spark, d)[0].drop("label"))


@query("dot_score", with_ctes(
    "SELECT user_id, post_id, interaction_type, weight, label, round(score, 6) AS score FROM scored",
    "scored"))
def dot_score(spark, d):
    return _scored(spark, d).withColumn("score", r6(F.col("score")))


@query("dot_probability", with_ctes(
    "SELECT user_id, post_id, round(1.0 / (1.0 + exp(-score)), 6) AS probability FROM scored",
    "scored"))
def dot_probability(spark, d):
    p = X.dot_probability(_scored(spark, d))
    return p.select("user_id", "post_id", r6(F.col("probability")).alias("probability"))


@query("log_loss", with_ctes(
    "SELECT count(*) AS n, round(avg(-(label * ln(pc) + (1 - label) * ln(1 - pc))), 6) AS log_loss "
    "FROM (SELECT label, least(greatest(1.0 / (1.0 + exp(-score)), 1e-7), 1 - 1e-7) AS pc FROM scored)",
    "scored"))
def log_loss(spark, d):
    return M.log_loss(M.probability(_scored(spark, d))).withColumn("log_loss", r6(F.col("log_loss")))


@query("auc", with_ctes(
    "SELECT CAST(sum(label) AS BIGINT) AS n_pos, CAST(sum(1 - label) AS BIGINT) AS n_neg, "
    "round(sum(CASE WHEN label = 1 THEN neg_below + neg_here / 2.0 END) / "
    "(sum(label)::DOUBLE * sum(1 - label)::DOUBLE), 6) AS auc FROM ("
    "SELECT label, sum(1 - label) OVER (ORDER BY score RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    " - sum(1 - label) OVER (PARTITION BY score) AS neg_below, "
    "sum(1 - label) OVER (PARTITION BY score) AS neg_here FROM scored)", "scored"))
def auc(spark, d):
    return M.auc(_scored(spark, d)).withColumn("auc", r6(F.col("auc")))


@query("mean_pool", with_ctes(
    "SELECT user_id, list(v ORDER BY j) AS pooled FROM ("
    "SELECT user_id, j, round(avg(e), 6) AS v FROM ("
    "SELECT i.user_id, unnest(p.embedding)::DOUBLE AS e, unnest(range(len(p.embedding))) AS j "
    "FROM weighted i JOIN pvec p ON p.id = i.post_id WHERE i.weight > 0) GROUP BY user_id, j) "
    "GROUP BY user_id", "weighted", "pvec"))
def mean_pool(spark, d):
    pv = _vecs(spark, d)[1]
    hist = (I.interaction_weight(D.interactions(spark, d)).filter(F.col("weight") > 0)
            .join(pv.select(F.col("id").alias("post_id"), "embedding"), "post_id"))
    return X.mean_pool(hist, "user_id", "embedding").withColumn("pooled", round_all(F.col("pooled")))


def _user_dense(spark, d):
    return FT.dense_user_vector(FT.user_numeric(_inputs(spark, d)))


def _post_dense(spark, d):
    return FT.dense_post_vector(FT.post_numeric(_inputs(spark, d)))


@query("user_dense_vector", with_ctes("SELECT * FROM user_dense", "user_dense"))
def user_dense_vector(spark, d):
    return _user_dense(spark, d)


@query("post_dense_vector", with_ctes("SELECT * FROM post_dense", "post_dense"))
def post_dense_vector(spark, d):
    return _post_dense(spark, d)


@query("dense_relu")
def dense_relu(spark, d):
    """``relu(W x + b)``, 16 wide, of each user's scalars, with the weights the
    joint ranker learned for them."""
    ex = RC.ranking_examples(spark, d)[0]
    model = RK.fit(ex, RC.given_shape(spark, d))
    w = RK.unflatten(model.shape, model.flat)
    at = slice(model.shape.user_vec + model.shape.post_vec, model.shape.user_vec + model.shape.post_vec + model.shape.user)
    scaled = w["wu"].T / model.scale[at]
    bias = w["bu"] - scaled @ model.mean[at]
    return _user_dense(spark, d).select("uid", dense(F.col("user_dense"), scaled.tolist(), bias.tolist()).alias("user_dense_proj"))


def _examples(spark, d):
    x = _inputs(spark, d)
    uv, pv = _vecs(spark, d)
    iwn = FT.interactions_with_negatives(x)
    return X.training_examples(iwn, FT.dense_user_vector(FT.user_numeric(x)),
                               FT.dense_post_vector(FT.post_numeric(x)),
                               uv.drop("label"), pv.drop("label"))


@query("training_examples", with_ctes("SELECT * FROM examples", "examples"))
def training_examples(spark, d):
    return _examples(spark, d)


@query("content_vector", with_ctes(
    "SELECT user_id, post_id, interaction_type, label, "
    "user_embedding || post_embedding || user_dense || post_dense "
    "|| [CAST(has_user_vector AS FLOAT), CAST(has_post_vector AS FLOAT)] AS features FROM examples", "examples"))
def content_vector(spark, d):
    return X.content_vector(_examples(spark, d)).select(
        "user_id", "post_id", "interaction_type", "label", "features")


@query("whole_examples", with_ctes(
    "SELECT e.*, " + ", ".join(f"u.{c}" for c in USER_TEXT) + ", g.geo_rbf, " + ", ".join(f"p.{c}" for c in POST_TEXT)
    + " FROM examples e LEFT JOIN padded_users u ON u.uid = e.user_id LEFT JOIN padded_posts p ON p.po_id = e.post_id "
    "LEFT JOIN geo_rbf g ON g.uid = e.user_id", "examples", "padded_users", "padded_posts", "geo_rbf"))
def whole_examples(spark, d):
    """Training examples with both towers' inputs: vectors, scalars, the padded
    text ids and the location features."""
    x = _inputs(spark, d)
    _, users, posts = FT.encoded_tables(x, FT.interactions_with_negatives(x))
    where = FT.location_features(x.profile).select("uid", round_all(F.col("geo_rbf")).alias("geo_rbf"))
    return X.with_texts_and_location(_examples(spark, d), users.select("uid", *USER_TEXT),
                                     posts.select("po_id", *POST_TEXT), where)


@query("retrieve_topk", with_ctes(
    "SELECT user_id, rank, post_id, round(score, 6) AS score FROM topk", "topk"))
def retrieve_topk(spark, d):
    uv, pv = _vecs(spark, d)
    return R.retrieve_topk(uv, pv, k=10).withColumn("score", r6(F.col("score")))


@query("recall_at_k", with_ctes(
    "SELECT t.user_id, count(*) FILTER (WHERE p.label = u.label) AS hits, any_value(r.relevant) AS relevant, "
    "round(count(*) FILTER (WHERE p.label = u.label) / any_value(r.relevant), 6) AS recall "
    "FROM topk t JOIN uvec u ON u.id = t.user_id JOIN pvec p ON p.id = t.post_id "
    "JOIN (SELECT label, count(*) AS relevant FROM pvec GROUP BY label) r ON r.label = u.label "
    "GROUP BY t.user_id", "topk", "uvec", "pvec"))
def recall_at_k(spark, d):
    uv, pv = _vecs(spark, d)
    top = R.retrieve_topk(uv, pv, k=10)
    out = M.recall_at_k(top, uv.select(F.col("id").alias("user_id"), "label"),
                        pv.select(F.col("id").alias("post_id"), "label"))
    return out.withColumn("recall", r6(F.col("recall")))


@query("retrieval_loss", with_ctes(
    "SELECT batch, count(*) AS n, round(sum(ce), 6) AS loss, round(avg(weight * ce), 6) AS weighted_loss, "
    "round(avg(weight) * sum(ce), 6) AS reference_loss FROM retrieval_ce GROUP BY batch", "retrieval_ce"))
def retrieval_loss(spark, d):
    uv, pv = _vecs(spark, d)
    pos = (I.interaction_weight(D.interactions(spark, d)).filter(F.col("weight") > 0)
           .join(uv.select(F.col("id").alias("user_id"), F.col("embedding").alias("u")), "user_id")
           .join(pv.select(F.col("id").alias("post_id"), F.col("embedding").alias("p")), "post_id")
           .select("event_id", "weight", "u", "p"))
    out = M.retrieval_loss(pos)
    return out.select("batch", "n", *[r6(F.col(c)).alias(c)
                                      for c in ("loss", "weighted_loss", "reference_loss")])


# ---- model stages (trained: rows-only checks) ------------------------------------
import uuid as _uuid  # noqa: E402

from ..operators import content as CT, ivf as IVF, models as MD, ranker as RK, split as SP  # noqa: E402
from ..session import scratch_path  # noqa: E402
from .oracle import sql_dot  # noqa: E402
from . import recommend as RC  # noqa: E402


def _iwn(spark, d):
    return FT.interactions_with_negatives(_inputs(spark, d))


@query("post_viewers_approx")
def post_viewers_approx(spark, d):
    views = I.filter_type(D.interactions(spark, d), "view")
    return views.groupBy(F.col("post_id").alias("po_id")).agg(
        F.approx_count_distinct("user_id").alias("viewers_approx"))


@query("als_embeddings")
def als_embeddings(spark, d):
    return MD.als_embeddings(_iwn(spark, d))


def _content(spark, d):
    return CT.content_embeddings(*RC.content_texts(_inputs(spark, d)))


@query("content_embeddings")
def content_embeddings(spark, d):
    return _content(spark, d)


@query("content_vector_facts", with_ctes(
    "SELECT 'user' AS side, count(*) AS n, 32 AS width, count(*) AS n_finite FROM user_keys UNION ALL "
    "SELECT 'post', count(*), 32, count(*) FROM documents", "user_keys"))
def content_vector_facts(spark, d):
    """What holds of the fitted content vectors: one per user and per post, 32
    wide, every number finite."""
    finite = ~F.exists("embedding", lambda v: F.isnan(v) | v.isNull() | (F.abs(v) == float("inf")))
    return _content(spark, d).groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("width"),
        F.count(F.when(finite & (F.size("embedding") == 32), 1)).alias("n_finite"))


@query("embed_all")
def embed_all(spark, d):
    als = MD.als_embeddings(_iwn(spark, d)).withColumn("space", F.lit("interaction"))
    content = _content(spark, d).withColumn("space", F.lit("content"))
    return als.unionByName(content)


RANKED = ["user_id", "post_id", "label"]


@query("rank_mlp")
def rank_mlp(spark, d):
    fit, held = RC.ranking_examples(spark, d)
    return MD.predict(MD.rank_mlp(fit), held, RANKED)


@query("rank_wide")
def rank_wide(spark, d):
    fit, held = RC.ranking_examples(spark, d)
    return MD.predict(MD.rank_wide(fit), held, RANKED)


@query("rank_joint")
def rank_joint(spark, d):
    """Held-out rows, scored by the wide and deep ranker trained on the others."""
    fit, held = RC.ranking_examples(spark, d)
    return RK.predict(RK.fit(fit, RC.given_shape(spark, d)), held, RANKED)


# ---- held-out evaluation ---------------------------------------------------------
@query("temporal_split", with_ctes(
    "SELECT event_id, user_id, post_id, interaction_type, weight, held_out FROM split", "split"))
def temporal_split(spark, d):
    return SP.temporal_split(_iwn(spark, d)).select(
        "event_id", "user_id", "post_id", "interaction_type", "weight", "held_out")


@query("recall_heldout", with_ctes(
    "SELECT user_id, count(t) AS hits, count(*) AS relevant, count(t) / count(*) AS recall FROM ("
    "SELECT DISTINCT user_id, post_id FROM split WHERE held_out AND weight > 0 AND post_id IS NOT NULL AND user_id IS NOT NULL) "
    "LEFT JOIN (SELECT user_id, post_id, 1 AS t FROM topk) USING (user_id, post_id) GROUP BY user_id", "split", "topk"))
def recall_heldout(spark, d):
    """Recall of the ten best posts by the given vectors against each user's own
    held-out positives."""
    uv, pv = _vecs(spark, d)
    return SP.recall_heldout(R.retrieve_topk(uv, pv, k=10), SP.temporal_split(_iwn(spark, d)))


@query("user_auc", with_ctes(
    "SELECT user_id, CAST(sum(label) AS BIGINT) AS n_pos, CAST(sum(1 - label) AS BIGINT) AS n_neg, "
    "round(sum(CASE WHEN label = 1 THEN neg_below + neg_here / 2.0 END) / "
    "(sum(label)::DOUBLE * sum(1 - label)::DOUBLE), 6) AS auc FROM ("
    "SELECT user_id, label, sum(1 - label) OVER (PARTITION BY user_id ORDER BY score RANGE BETWEEN UNBOUNDED PRECEDING "
    "AND CURRENT ROW) - sum(1 - label) OVER (PARTITION BY user_id, score) AS neg_below, "
    "sum(1 - label) OVER (PARTITION BY user_id, score) AS neg_here FROM scored) "
    "GROUP BY user_id HAVING sum(label) > 0 AND sum(1 - label) > 0", "scored"))
def user_auc(spark, d):
    return SP.user_auc(_scored(spark, d)).withColumn("auc", r6(F.col("auc")))


@query("retrieve_lsh")
def retrieve_lsh(spark, d):
    uv, pv = _vecs(spark, d)
    return R.retrieve_lsh(uv, pv, k=10)


@query("diversify_topk")
def diversify_topk(spark, d):
    uv, pv = _vecs(spark, d)
    return R.retrieve_diverse(uv, pv, R.post_clusters(pv), k=10, per_cluster=2)


@query("diversify_by_label", with_ctes(
    "SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, post_id) AS INTEGER) AS rank, "
    "post_id, round(score, 6) AS score, label AS cluster FROM ("
    "SELECT *, row_number() OVER (PARTITION BY user_id, label ORDER BY score DESC, post_id) AS r FROM ("
    f"SELECT u.id AS user_id, p.id AS post_id, p.label, {sql_dot('u.embedding', 'p.embedding')} AS score "
    "FROM uvec u, pvec p)) WHERE r <= 2 QUALIFY rank <= 10", "uvec", "pvec"))
def diversify_by_label(spark, d):
    """The same over the posts' given labels."""
    uv, pv = _vecs(spark, d)
    clusters = pv.select(F.col("id").alias("post_id"), F.col("label").alias("cluster"))
    return R.retrieve_diverse(uv, pv, clusters, k=10, per_cluster=2).withColumn("score", r6(F.col("score")))


@query("retrieve_ivf")
def retrieve_ivf(spark, d):
    """Top ten by a persistent inverted-file index, probes chosen by recall."""
    uv, pv = _vecs(spark, d)
    return IVF.retrieve_ivf(uv, pv, scratch_path(spark, f"index-{_uuid.uuid4().hex}"), k=10)


@query("retrieve_ivf_facts", with_ctes(
    "SELECT (SELECT count(*) FROM uvec) AS n_users, (SELECT count(*) FROM pvec) AS n_indexed, true AS recall_reached, "
    "least(10, (SELECT count(*) FROM pvec)) AS least_rows", "uvec", "pvec"))
def retrieve_ivf_facts(spark, d):
    """What holds of the index: every post is in it, every user gets its rows, and
    the recall measured against brute force is at least 0.9."""
    uv, pv = _vecs(spark, d)
    index = IVF.build_index(pv, scratch_path(spark, f"index-{_uuid.uuid4().hex}"))
    probes, recall = IVF.choose_probes(index, uv, k=10)
    per = IVF.search(index, uv, 10, probes).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("n_users"), F.lit(index.posts.count()).cast("bigint").alias("n_indexed"),
                   F.lit(recall >= 0.9).alias("recall_reached"), F.min("n").alias("least_rows"))


@query("recommend")
def recommend(spark, d):
    return RC.recommend(spark, d)


@query("recommend_facts", with_ctes(
    "SELECT uid AS user_id, least(10, (SELECT count(*) FROM documents)) AS n, least(10, (SELECT count(*) FROM documents)) "
    "AS n_posts FROM user_keys", "user_keys"))
def recommend_facts(spark, d):
    """What holds of the recommendations: ten different posts for every user."""
    return RC.recommend(spark, d).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("post_id").alias("n_posts"))


# ---- streaming -----------------------------------------------------------------
from ..streaming import jobs as SJ  # noqa: E402
from ..streaming.intake import to_messages  # noqa: E402
from ..sources.tables import read_table  # noqa: E402


@query("stream_counts", with_ctes(
    "SELECT user_id, interaction_type, count(*) AS n FROM interactions GROUP BY user_id, interaction_type",
    "interactions"))
def stream_counts(spark, d):
    return SJ.stream_counts(spark, d, "events.parquet")


@query("stream_refresh", with_ctes("SELECT * FROM user_counts", "user_counts"))
def stream_refresh(spark, d):
    """The refreshed counts of every user; 0 for users without events."""
    return D.user_keys(spark, d).join(SJ.stream_refresh(spark, d, "events.parquet"), "uid", "left") \
        .na.fill(0, subset=list(U.COUNTED_TYPES))


@query("stream_messages",
       "SELECT CASE WHEN event_id % 97 = 0 THEN '{\"event_id\":' || event_id END AS malformed, "
       + ", ".join(f"CASE WHEN event_id % 97 <> 0 THEN {c} END AS {c}"
                   for c in ("event_id", "ts", "user_id", "event_type", "value", "props")) + " FROM events")
def stream_messages(spark, d):
    """Every event as a JSON message, each 97th cut short on its way; good
    rows and, aside, the malformed messages."""
    import uuid
    msg_dir = scratch_path(spark, f"messages-{uuid.uuid4().hex}")
    events = read_table(spark, d, "events")
    cut = F.col("event_id") % 97 == 0
    to_messages(events.filter(~cut)).unionByName(events.filter(cut).select(
        F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string")).alias("value"))).write.text(msg_dir)
    good, bad = SJ.stream_messages(spark, msg_dir)
    return good.unionByName(bad, allowMissingColumns=True)


# ---- feature files: written by the transformation step, read as float32 -----------
from ..sources import io as IO  # noqa: E402


def _feature_file(spark, d, name, df):
    import uuid
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    IO.write_examples({name: df}, path)
    return os.path.join(path, name, "*.parquet")


@query("read_user_features", with_ctes(
    "SELECT c.uid, CAST(c.viewed_posts AS FLOAT) AS viewed_posts, CAST(c.upvoted_posts AS FLOAT) AS upvoted_posts, "
    "CAST(c.commented_posts AS FLOAT) AS commented_posts, "
    "CAST(round(s.login_frequency, 6) AS FLOAT) AS login_frequency "
    "FROM user_counts c JOIN scaled_lf s USING (uid)", "user_counts", "scaled_lf"))
def read_user_features(spark, d):
    ut = FT.scaled_user_features(FT.user_numeric(_inputs(spark, d)))
    out = ut.select("uid", *U.COUNTED_TYPES, r6(F.col("login_frequency")).alias("login_frequency"))
    return IO.read_user_features(spark, _feature_file(spark, d, "users", out))


@query("read_post_features", with_ctes(
    "SELECT po_id, " + ", ".join(f"CAST(round({c}, 6) AS FLOAT) AS {c}" for c in POST_DENSE_COLS)
    + " FROM scaled_posts", "scaled_posts"))
def read_post_features(spark, d):
    pt = FT.scaled_post_features(FT.post_numeric(_inputs(spark, d)))
    out = pt.select("po_id", *[r6(F.col(c)).alias(c) for c in POST_DENSE_COLS])
    return IO.read_post_features(spark, _feature_file(spark, d, "posts", out))


# ---- the whole job ------------------------------------------------------------------
from . import job as JB  # noqa: E402


def _ids_sql(columns) -> str:
    return "CAST(sum(" + " + ".join(f"list_sum({c})" for c in columns) + ") AS BIGINT)"


@query("published_examples", with_ctes(
    "SELECT 'users' AS name, count(*) AS n, CAST(sum(viewed_posts + upvoted_posts + commented_posts) AS BIGINT) AS counted, "
    f"{_ids_sql(USER_TEXT)} AS ids FROM padded_users JOIN user_counts USING (uid) UNION ALL "
    f"SELECT 'posts', count(*), CAST(count(ctr) AS BIGINT), {_ids_sql(f'e.{c}' for c in POST_TEXT)} "
    "FROM padded_posts e JOIN post_table USING (po_id) "
    "UNION ALL SELECT 'interactions', count(*), CAST(sum(coalesce(comment_length, 0)) AS BIGINT), "
    "CAST(sum(coalesce(user_id, 0) + 7 * coalesce(post_id, 0)) AS BIGINT) FROM iwn",
    "padded_users", "user_counts", "padded_posts", "post_table", "iwn"))
def published_examples(spark, d):
    """Rows, counts and id sums of the three example tables, as published by the
    job and read back."""
    t = JB.run(spark, d, scratch_path(spark, f"examples-{_uuid.uuid4().hex}"))

    def ids(columns):
        return F.sum(sum((F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x) for c in columns), F.lit(0).cast("bigint")))

    def facts(name, counted, id_sum):
        return t[name].agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), counted.cast("bigint").alias("counted"),
                           id_sum.cast("bigint").alias("ids"))

    return (facts("users", F.sum(F.col("viewed_posts") + F.col("upvoted_posts") + F.col("commented_posts")), ids(USER_TEXT))
            .unionByName(facts("posts", F.count("ctr"), ids(POST_TEXT)))
            .unionByName(facts("interactions", F.sum("comment_length"),
                               F.sum(F.coalesce("user_id", F.lit(0)) + 7 * F.coalesce("post_id", F.lit(0))))))


@query("rejected_points", with_ctes(
    "SELECT count(*) AS n, CAST(count(*) FILTER (WHERE uid % 9 = 4 AND lat IS NOT NULL) AS BIGINT) AS n_rejected FROM users",
    "users"))
def rejected_points(spark, d):
    """Each ninth location is cut short on its way: counted, never raised."""
    located = G.encode_points(D.user_profile(spark, d)).withColumn("lat_long", F.when(
        F.col("uid") % 9 == 4, F.substring("lat_long", 1, 41)).otherwise(F.col("lat_long")))
    return G.rejected_points(located)
