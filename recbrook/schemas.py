"""Declared schemas.  Library readers never infer types."""

from __future__ import annotations

from pyspark.sql import types as T

L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
TS = T.TimestampNTZType()
FLOAT = T.FloatType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---- base tables (the given parquet files) ---------------------------------
BASE = {
    "region": _struct(("r_regionkey", I), ("r_name", S)),
    "nation": _struct(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _struct(("c_custkey", L), ("c_name", S), ("c_nationkey", I),
                        ("c_acctbal", D), ("c_mktsegment", S)),
    "supplier": _struct(("s_suppkey", L), ("s_name", S), ("s_nationkey", I),
                        ("s_acctbal", D)),
    "part": _struct(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S),
                    ("p_size", I), ("p_retailprice", D)),
    "orders": _struct(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S),
                      ("o_totalprice", D), ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _struct(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L),
                        ("l_linenumber", I), ("l_quantity", D), ("l_extendedprice", D),
                        ("l_discount", D), ("l_tax", D), ("l_returnflag", S),
                        ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _struct(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S),
                      ("value", D), ("props", S)),
    "documents": _struct(("doc_id", L), ("text", S), ("lang", S), ("source", S),
                         ("n_chars", L)),
    "embeddings": _struct(("vec_id", L), ("embedding", T.ArrayType(FLOAT)), ("label", I)),
    "pages": _struct(("page_id", L), ("url", S), ("html", S)),
    "benchmark": _struct(("item_id", L), ("text", S)),
    "labels": _struct(("doc_id", L), ("quality", I), ("toxic", I)),
    "conversations": _struct(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
}

# ---- recommender tables (what the warehouse holds) -------------------------
INTERACTIONS = _struct(("event_id", L), ("user_id", L), ("post_id", L),
                       ("interaction_type", S), ("interaction_time", TS),
                       ("view_duration_secs", D), ("comment_length", I))
COMMENTS = _struct(("po_id", L), ("turn", L), ("content", S))
POSTS = _struct(("po_id", L), ("title", S), ("description", S), ("upvotes", L),
                ("downvotes", L), ("votes", T.ArrayType(L)), ("views", T.ArrayType(L)),
                ("view_lengths", T.ArrayType(D)))
COLLABS = _struct(("collab_id", L), ("owner_uid", L), ("title", S),
                  ("team_uids", T.ArrayType(L)))
USERS = _struct(("uid", L), ("passions", T.ArrayType(S)), ("bio", S), ("lat", D),
                ("lon", D), ("fed", T.ArrayType(L)), ("login_times", T.ArrayType(TS)))
VECTORS = _struct(("side", S), ("id", L), ("embedding", T.ArrayType(FLOAT)), ("label", I))

# Feature columns consumed by the ranking model, in model order.
USER_DENSE_COLS = ["viewed_posts", "upvoted_posts", "commented_posts", "login_frequency"]
POST_DENSE_COLS = ["post_length", "vote_count", "upvote_count", "view_count",
                   "comment_count", "avg_time_viewed", "ctr"]
USER_FEATURE_FILE = _struct(*[(c, FLOAT) for c in ["uid"] + USER_DENSE_COLS])
POST_FEATURE_FILE = _struct(*[(c, FLOAT) for c in ["po_id"] + POST_DENSE_COLS])
