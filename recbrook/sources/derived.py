"""The recommender's input tables, derived from the given tables.

The reference reads five warehouse tables (users, posts, posts_comments,
collabs, user_post_interactions).  These functions build them from the
given parquet tables with fixed rules so that Spark and the DuckDB oracle
see the same rows.  Every function is lazy: callers' projections and
filters are pushed through to the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Fixed values of the derivation rules.
TITLE_ELEMENT = r"(?is)<title[^>]*>(.*?)</title>"
TITLE_REFERENCES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
INTERACTION_TYPE_OF_EVENT = {"view": "view", "purchase": "upvote", "click": "comment"}


def interaction_type_of(event_type: Column, event_id: Column) -> Column:
    expr = None
    for ev, it in INTERACTION_TYPE_OF_EVENT.items():
        expr = (F.when(event_type == ev, F.lit(it)) if expr is None
                else expr.when(event_type == ev, F.lit(it)))
    # odd error events are an unrecognised type; even ones have no type
    return expr.when((event_type == "error") & (event_id % 2 == 1), F.lit("error"))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions_from_events(read_table(spark, sf_dir, "events"))


def interactions_from_events(events: DataFrame) -> DataFrame:
    """Interaction rows from an events frame (batch or streaming)."""
    ev = events.filter(F.col("event_type") != "signup")
    et = F.col("event_type")
    return ev.select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("post_id"),
        interaction_type_of(et, F.col("event_id")).alias("interaction_type"),
        F.col("ts").alias("interaction_time"),
        F.when(et == "view", F.col("value")).alias("view_duration_secs"),
        F.when(et == "click", F.floor("value").cast("int")).alias("comment_length"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("po_id"), "turn", F.col("text").alias("content"))


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(po_id, title): the whole ``<title>`` of the post's page, empty where
    the page has none."""
    title = F.regexp_extract("html", TITLE_ELEMENT, 1)
    for ref, char in TITLE_REFERENCES:
        title = F.replace(title, F.lit(ref), F.lit(char))
    return read_table(spark, sf_dir, "pages").select(F.col("page_id").alias("po_id"), title.alias("title"))


def post_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``po_id`` of every post, without its texts."""
    return read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("po_id"))


def post_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(po_id, description)."""
    return read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("po_id"), F.col("text").alias("description"))


def post_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(po_id, title) of every post, NULL for a post without a page; reads
    no post bodies."""
    return post_keys(spark, sf_dir).join(page_titles(spark, sf_dir).hint("merge"), "po_id", "left")


def post_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scalar columns of posts: id, title, description.  Both sides
    carry long texts, so the join is never a broadcast."""
    return (post_bodies(spark, sf_dir).join(page_titles(spark, sf_dir).hint("merge"), "po_id", "left")
            .select("po_id", "title", "description"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts as the warehouse stores them, with per-post arrays.

    The vote/view arrays are the reference's storage format; post features
    never read them (they aggregate interactions instead, see
    ``operators.posts``), so this builder only serves the posts scan.
    """
    it = interactions(spark, sf_dir)
    t = F.col("interaction_type")
    vote = t.isin("upvote", "error")
    per_post = it.groupBy("post_id").agg(
        F.count(F.when(t == "upvote", 1)).alias("upvotes"),
        F.count(F.when(t == "error", 1)).alias("downvotes"),
        F.sort_array(F.collect_list(F.when(vote, F.col("user_id")))).alias("votes"),
        F.sort_array(F.collect_list(F.when(t == "view", F.col("user_id")))).alias("views"),
        F.sort_array(F.collect_list(
            F.when(t == "view", F.col("view_duration_secs")))).alias("view_lengths"),
    ).withColumnRenamed("post_id", "po_id")
    return post_text(spark, sf_dir).join(per_post, "po_id", "left")


def collabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    team = (read_table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(F.sort_array(F.collect_set("l_suppkey")).alias("team_uids")))
    return orders.join(team, orders.o_orderkey == team.l_orderkey, "left").select(
        F.col("o_orderkey").alias("collab_id"),
        F.col("o_custkey").alias("owner_uid"),
        F.concat("o_orderpriority", F.lit(" "), F.col("o_orderkey").cast("string")).alias("title"),
        "team_uids",
    )


def user_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``uid`` of every user, without the wide user columns."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("c_custkey").alias("uid"))


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per login: (uid, ts)."""
    return (read_table(spark, sf_dir, "events")
            .filter(F.col("event_type") == "signup")
            .select(F.col("user_id").alias("uid"), "ts"))


def user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-user columns that need no other table than customer and
    nation: uid, passions, lat, lon, fed.  Operators that read only these
    use this frame, so no bio or login join is planned for them."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    u = F.col("c_custkey")
    no_geo = u % 17 == 0
    fed = (F.when(u % 13 == 0, F.lit(None))
           .when(u % 11 == 0, F.array().cast("array<bigint>"))
           .otherwise(F.transform(F.sequence(F.lit(0), F.lit(19)),
                                  lambda i: (u * 7 + i * 13) % 120)))
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        u.alias("uid"),
        F.when(u % 7 == 0, F.lit(None)).otherwise(
            F.array("c_mktsegment", "n_name")).alias("passions"),
        F.when(no_geo, F.lit(None)).otherwise((u * 37 % 18000) / 100 - 90).alias("lat"),
        F.when(no_geo, F.lit(None)).otherwise((u * 91 % 36000) / 100 - 180).alias("lon"),
        fed.alias("fed"),
    )


def user_bio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, bio) for users that have one.  An inner join, so Spark may
    build on the user keys and stream the long texts in parallel (a left
    join from users would have to broadcast the texts instead)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text").hint("merge")
    keys = user_keys(spark, sf_dir)
    return d.join(keys, d.doc_id == keys.uid).select("uid", F.col("text").alias("bio"))


def user_login_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, login_times) for every user; NULL without logins."""
    login = logins(spark, sf_dir).groupBy("uid").agg(
        F.sort_array(F.collect_list("ts")).alias("login_times"))
    return user_keys(spark, sf_dir).join(login, "uid", "left")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full users table: profile, ``bio`` and sorted ``login_times``.

    Joins that carry long texts are hinted to sort-merge: Spark sizes a
    string column at a fixed 20 bytes, so it would otherwise broadcast the
    texts and leave the text work to one task."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text").hint("merge")
    login = logins(spark, sf_dir).groupBy("uid").agg(
        F.sort_array(F.collect_list("ts")).alias("login_times"))
    base = user_profile(spark, sf_dir)
    return (base.join(d, base.uid == d.doc_id, "left")
            .join(login, "uid", "left")
            .select("uid", "passions", F.col("text").alias("bio"), "lat", "lon", "fed",
                    "login_times"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in learned vectors: even ids are users, odd ids are posts."""
    e = read_table(spark, sf_dir, "embeddings")
    even = F.col("vec_id") % 2 == 0
    return e.select(
        F.when(even, F.lit("user")).otherwise(F.lit("post")).alias("side"),
        F.expr("vec_id div 2").alias("id"),
        "embedding",
        "label",
    )


def side_vectors(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    return vectors(spark, sf_dir).filter(F.col("side") == side).drop("side")
