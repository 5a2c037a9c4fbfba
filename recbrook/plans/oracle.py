"""DuckDB oracle SQL.

The driver registers only the given tables as views, so each oracle query
restates the recommender tables it needs as CTEs.  ``with_ctes`` pulls in
the named CTEs and their dependencies in order.
"""

from __future__ import annotations

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order)
    return f"WITH {parts}\n{body}"


# ---- recommender tables ------------------------------------------------------
cte("interactions", [], """
SELECT event_id, user_id,
       CAST(json_extract(props, '$.k') AS BIGINT) AS post_id,
       CASE WHEN event_type = 'view' THEN 'view'
            WHEN event_type = 'purchase' THEN 'upvote'
            WHEN event_type = 'click' THEN 'comment'
            WHEN event_type = 'error' AND event_id % 2 = 1 THEN 'error' END AS interaction_type,
       ts AS interaction_time,
       CASE WHEN event_type = 'view' THEN value END AS view_duration_secs,
       CASE WHEN event_type = 'click' THEN CAST(floor(value) AS INTEGER) END AS comment_length
FROM events WHERE event_type <> 'signup'""")

cte("comments", [], "SELECT conv_id AS po_id, turn, text AS content FROM conversations")

cte("post_text", [], """
SELECT doc_id AS po_id, title, text AS description FROM documents LEFT JOIN (
  SELECT page_id, replace(replace(replace(replace(replace(
           regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1),
           '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&') AS title
  FROM pages) ON page_id = doc_id""")

cte("posts", ["interactions", "post_text"], """
SELECT p.po_id, p.title, p.description, g.upvotes, g.downvotes, g.votes, g."views", g.view_lengths
FROM post_text p LEFT JOIN (
  SELECT post_id,
         count(*) FILTER (WHERE interaction_type = 'upvote') AS upvotes,
         count(*) FILTER (WHERE interaction_type = 'error') AS downvotes,
         coalesce(list_sort(list(user_id) FILTER (WHERE interaction_type IN ('upvote', 'error'))), []) AS votes,
         coalesce(list_sort(list(user_id) FILTER (WHERE interaction_type = 'view')), []) AS "views",
         coalesce(list_sort(list(view_duration_secs) FILTER (WHERE interaction_type = 'view')), []) AS view_lengths
  FROM interactions GROUP BY post_id) g ON g.post_id = p.po_id""")

cte("collabs", [], """
SELECT o.o_orderkey AS collab_id, o.o_custkey AS owner_uid,
       o.o_orderpriority || ' ' || CAST(o.o_orderkey AS VARCHAR) AS title, t.team_uids
FROM orders o LEFT JOIN (
  SELECT l_orderkey, list_sort(list(DISTINCT l_suppkey)) AS team_uids FROM lineitem GROUP BY l_orderkey
) t ON t.l_orderkey = o.o_orderkey""")

cte("user_keys", [], """
SELECT c_custkey AS uid FROM customer JOIN nation ON c_nationkey = n_nationkey""")

cte("users", [], """
SELECT c.c_custkey AS uid,
       CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE [c.c_mktsegment, n.n_name] END AS passions,
       d.text AS bio,
       CASE WHEN c.c_custkey % 17 = 0 THEN NULL ELSE (c.c_custkey * 37 % 18000) / 100 - 90 END AS lat,
       CASE WHEN c.c_custkey % 17 = 0 THEN NULL ELSE (c.c_custkey * 91 % 36000) / 100 - 180 END AS lon,
       CASE WHEN c.c_custkey % 13 = 0 THEN NULL
            WHEN c.c_custkey % 11 = 0 THEN CAST([] AS BIGINT[])
            ELSE list_transform(range(0, 20), lambda i: (c.c_custkey * 7 + i * 13) % 120) END AS fed,
       s.login_times
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN documents d ON d.doc_id = c.c_custkey
LEFT JOIN (SELECT user_id, list_sort(list(ts)) AS login_times FROM events
           WHERE event_type = 'signup' GROUP BY user_id) s ON s.user_id = c.c_custkey""")

cte("vectors", [], """
SELECT CASE WHEN vec_id % 2 = 0 THEN 'user' ELSE 'post' END AS side, vec_id // 2 AS id,
       embedding, label FROM embeddings""")

# ---- derived frames ------------------------------------------------------------
cte("weighted", ["interactions"], """
SELECT *, CASE WHEN interaction_type = 'upvote' THEN 2.0 WHEN interaction_type = 'comment' THEN 1.5
               WHEN interaction_type = 'view' THEN 1.0 ELSE 0.0 END::DOUBLE AS weight
FROM interactions""")

cte("fed", ["users"], "SELECT uid AS user_id, unnest(fed) AS post_id FROM users")

cte("negatives", ["fed", "interactions"], """
SELECT f.user_id, f.post_id FROM fed f
WHERE NOT EXISTS (SELECT 1 FROM interactions i WHERE i.user_id = f.user_id AND i.post_id = f.post_id)""")

cte("iwn", ["weighted", "negatives"], """
SELECT event_id, user_id, post_id, interaction_type, interaction_time, view_duration_secs,
       comment_length, weight FROM weighted
UNION ALL
SELECT NULL, user_id, post_id, 'no_interaction', NULL, NULL, NULL, 0.0 FROM negatives""")

cte("post_comments", ["post_text", "comments"], """
SELECT p.po_id, c.comments FROM post_text p LEFT JOIN (
  SELECT po_id, list(content ORDER BY turn, content) AS comments FROM comments GROUP BY po_id
) c USING (po_id)""")

cte("post_eng", ["interactions"], """
SELECT post_id AS po_id,
       count(*) FILTER (WHERE interaction_type = 'upvote') AS upvotes,
       count(*) FILTER (WHERE interaction_type = 'error') AS downvotes,
       count(user_id) FILTER (WHERE interaction_type IN ('upvote', 'error')) AS vote_count,
       count(user_id) FILTER (WHERE interaction_type = 'view') AS view_count,
       count(*) FILTER (WHERE interaction_type = 'view') AS n_view_lengths,
       sum(view_duration_secs) FILTER (WHERE interaction_type = 'view') AS view_seconds
FROM interactions GROUP BY post_id""")

cte("post_features", ["post_text", "post_eng", "post_comments"], """
SELECT p.po_id, CAST(length(p.description) AS BIGINT) AS post_length, e.vote_count,
       e.upvotes - e.downvotes AS upvote_count, e.view_count,
       CAST(len(c.comments) AS BIGINT) AS comment_count,
       CASE WHEN e.n_view_lengths > 0 THEN e.view_seconds / e.n_view_lengths ELSE 0.0 END AS avg_time_viewed
FROM post_text p LEFT JOIN post_eng e USING (po_id) LEFT JOIN post_comments c USING (po_id)""")

cte("post_ctr", ["post_text", "fed", "interactions"], """
SELECT p.po_id, coalesce(f.n, 0) AS fed_users, coalesce(v.n, 0) AS viewers,
       coalesce(f.n, 0) / nullif(coalesce(v.n, 0), 0) AS ctr,
       coalesce(v.n, 0) / nullif(coalesce(f.n, 0), 0) AS view_through_rate
FROM post_text p
LEFT JOIN (SELECT post_id, count(DISTINCT user_id) AS n FROM fed GROUP BY post_id) f ON f.post_id = p.po_id
LEFT JOIN (SELECT post_id, count(DISTINCT user_id) AS n FROM interactions
           WHERE interaction_type = 'view' GROUP BY post_id) v ON v.post_id = p.po_id""")

cte("user_counts", ["user_keys", "interactions"], """
SELECT u.uid, coalesce(c.viewed_posts, 0) AS viewed_posts, coalesce(c.upvoted_posts, 0) AS upvoted_posts,
       coalesce(c.commented_posts, 0) AS commented_posts
FROM user_keys u LEFT JOIN (
  SELECT user_id AS uid,
         count(post_id) FILTER (WHERE interaction_type = 'view') AS viewed_posts,
         count(post_id) FILTER (WHERE interaction_type = 'upvote') AS upvoted_posts,
         count(post_id) FILTER (WHERE interaction_type = 'comment') AS commented_posts
  FROM interactions GROUP BY user_id) c USING (uid)""")

cte("login_intervals", ["users"], """
SELECT uid, CAST(i AS INTEGER) AS i, date_sub('second', login_times[i + 1], login_times[i + 2]) AS interval
FROM (SELECT uid, login_times, unnest(range(0, len(login_times) - 1)) AS i
      FROM users WHERE len(login_times) >= 2)""")

cte("login_frequency", ["users", "login_intervals"], """
SELECT u.uid, CASE WHEN len(u.login_times) >= 2 THEN coalesce(g.f, 0.0) END AS login_frequency
FROM users u LEFT JOIN (
  SELECT uid, exp(sum(ln(interval)) / count(interval)) AS f FROM login_intervals
  WHERE interval > 0 GROUP BY uid) g USING (uid)""")

cte("project_titles", ["user_keys", "collabs"], """
SELECT u.uid, t.project_titles FROM user_keys u LEFT JOIN (
  SELECT uid, list_sort(list(title)) AS project_titles FROM (
    SELECT DISTINCT collab_id, title, unnest(list_concat([owner_uid], team_uids)) AS uid
    FROM collabs WHERE team_uids IS NOT NULL)
  GROUP BY uid) t USING (uid)""")

cte("recent_titles", ["user_keys", "iwn", "post_text"], """
SELECT u.uid, r.recent_titles FROM user_keys u LEFT JOIN (
  SELECT user_id AS uid, list(title ORDER BY rn) AS recent_titles FROM (
    SELECT i.user_id, p.title,
           row_number() OVER (PARTITION BY i.user_id
                              ORDER BY i.interaction_time DESC NULLS LAST, i.post_id) AS rn
    FROM iwn i JOIN post_text p ON i.post_id = p.po_id)
  WHERE rn <= 10 GROUP BY user_id) r USING (uid)""")


# ---- feature tables, cleaning, scaling, geo, text ---------------------------------
def scale_sql(src: str, key: str, cols: list[str], digits: int | None = None) -> str:
    """z-scores with population std (0 -> 1), NULL kept; optional rounding."""
    stats = ", ".join(f"avg({c}) AS {c}__m, stddev_pop({c}) AS {c}__s" for c in cols)
    sel = []
    for c in cols:
        z = f"({c} - {c}__m) / CASE WHEN {c}__s = 0 THEN 1 ELSE {c}__s END"
        sel.append(f"round({z}, {digits}) AS {c}" if digits is not None else f"{z} AS {c}")
    return f"SELECT {key}, {', '.join(sel)} FROM {src}, (SELECT {stats} FROM {src}) st"


cte("user_table", ["users", "login_frequency", "user_counts", "project_titles", "recent_titles"], """
SELECT u.*, lf.login_frequency, uc.viewed_posts, uc.upvoted_posts, uc.commented_posts,
       pt.project_titles, rt.recent_titles
FROM users u LEFT JOIN login_frequency lf USING (uid) LEFT JOIN user_counts uc USING (uid)
LEFT JOIN project_titles pt USING (uid) LEFT JOIN recent_titles rt USING (uid)""")

cte("post_table", ["post_text", "post_comments", "post_features", "post_ctr"], """
SELECT p.po_id, p.title, p.description, c.comments, f.post_length, f.vote_count, f.upvote_count,
       f.view_count, f.comment_count, f.avg_time_viewed, r.ctr
FROM post_text p LEFT JOIN post_comments c USING (po_id) LEFT JOIN post_features f USING (po_id)
LEFT JOIN post_ctr r USING (po_id)""")

cte("time_parts", ["iwn"], """
SELECT *, CAST(hour(interaction_time) AS INTEGER) AS hour_of_day,
       CAST(isodow(interaction_time) - 1 AS INTEGER) AS day_of_week FROM iwn""")

cte("clean_users", ["user_table"], """
SELECT uid, coalesce(array_to_string(passions, ' '), '') AS passions,
       coalesce(array_to_string(project_titles, ' '), '') AS project_titles,
       coalesce(bio, '') AS bio,
       coalesce(array_to_string(recent_titles, ' '), '') AS recent_titles,
       viewed_posts, upvoted_posts, commented_posts
FROM user_table""")

cte("clean_posts", ["post_table"], """
SELECT po_id, coalesce(title, '') AS title, description, coalesce(array_to_string(comments, ' '), '') AS comments
FROM post_table""")

cte("points", ["users"], """
SELECT uid, CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lon ELSE 1.0 END AS lon,
            CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lat ELSE 1.0 END AS lat
FROM users""")

cte("scaled_points", ["points"], scale_sql("points", "uid", ["lat", "lon"]))

cte("rbf_centers", ["scaled_points"], """
SELECT CAST(row_number() OVER (ORDER BY md5(CAST(uid AS VARCHAR)), uid) - 1 AS INTEGER) AS k,
       uid, lat, lon
FROM (SELECT * FROM scaled_points ORDER BY md5(CAST(uid AS VARCHAR)), uid LIMIT 5)""")

cte("geo_rbf", ["scaled_points", "rbf_centers"], """
SELECT s.uid,
       list(round(exp(-0.1 * ((s.lat - c.lat) * (s.lat - c.lat) + (s.lon - c.lon) * (s.lon - c.lon))), 6)
            ORDER BY c.k) AS geo_rbf
FROM scaled_points s, rbf_centers c GROUP BY s.uid""")

USER_TEXT = {"passions": 10, "project_titles": 10, "bio": 50, "recent_titles": 10}
POST_TEXT = {"title": 10, "description": 100, "comments": 100}


def tok(expr: str) -> str:
    return (f"list_filter(string_split_regex(lower(coalesce({expr}, '')), '[^\\p{{L}}\\p{{N}}]+'), "
            f"lambda t: t <> '')")


def enc_sql(src: str, key: str, lengths: dict[str, int]) -> str:
    """Marks and token ids per text column: tokens looked up by a join."""
    cols, joins = [], []
    for c, n in lengths.items():
        cols.append(f"[CAST(2 AS BIGINT)] || coalesce(e_{c}.ids, []) || [CAST(3 AS BIGINT)] AS {c}")
        joins.append(
            f"LEFT JOIN (SELECT {key}, list(coalesce(token_id, 1) ORDER BY pos) AS ids FROM ("
            f"SELECT {key}, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM ("
            f"SELECT {key}, ({tok(c)})[1:{n - 2}] AS toks FROM {src})) LEFT JOIN vocab USING (token) "
            f"GROUP BY {key}) e_{c} USING ({key})")
    return f"SELECT {key}, {', '.join(cols)} FROM {src} {' '.join(joins)}"


cte("corpus", ["clean_users", "clean_posts"], "\nUNION ALL\n".join(
    [f"SELECT {c} AS text FROM clean_users" for c in USER_TEXT]
    + [f"SELECT {c} AS text FROM clean_posts" for c in POST_TEXT]))

cte("vocab", ["corpus"], f"""
SELECT token, row_number() OVER (ORDER BY n DESC, token) + 3 AS token_id, n FROM (
  SELECT token, count(*) AS n FROM (SELECT unnest({tok('text')}) AS token FROM corpus)
  GROUP BY token)""")

cte("enc_users", ["clean_users", "vocab"], enc_sql("clean_users", "uid", USER_TEXT))
cte("enc_posts", ["clean_posts", "vocab"], enc_sql("clean_posts", "po_id", POST_TEXT))


def widths_sql(src: str, lengths: dict[str, int]) -> str:
    return "SELECT " + ", ".join(
        f"CAST(least(max(len({c})), {n}) AS INTEGER) AS {c}" for c, n in lengths.items()) + f" FROM {src}"


cte("widths_users", ["enc_users"], widths_sql("enc_users", USER_TEXT))
cte("widths_posts", ["enc_posts"], widths_sql("enc_posts", POST_TEXT))

cte("padded_users", ["enc_users", "widths_users"],
    "SELECT e.uid, " + ", ".join(f"list_resize(e.{c}, w.{c}, 0) AS {c}" for c in USER_TEXT)
    + " FROM enc_users e, widths_users w")

cte("padded_posts", ["enc_posts", "widths_posts"],
    "SELECT e.po_id, " + ", ".join(f"list_resize(e.{c}, w.{c}, 0) AS {c}" for c in POST_TEXT)
    + " FROM enc_posts e, widths_posts w")


# ---- vectors, examples, retrieval, metrics ---------------------------------------
def sql_fold_sum(lst: str) -> str:
    """Left-to-right sum, the same order as Spark's ``aggregate``."""
    return f"list_reduce({lst}, lambda a, b: a + b)"


def sql_dot(a: str, b: str) -> str:
    return sql_fold_sum(f"list_transform(range(1, len({a}) + 1), lambda i: {a}[i]::DOUBLE * {b}[i]::DOUBLE)")


cte("uvec", ["vectors"], "SELECT id, embedding, label FROM vectors WHERE side = 'user'")
cte("pvec", ["vectors"], "SELECT id, embedding, label FROM vectors WHERE side = 'post'")

cte("scored", ["iwn", "uvec", "pvec"], f"""
SELECT i.user_id, i.post_id, i.interaction_type, i.weight, CAST(i.weight > 0 AS INTEGER) AS label,
       coalesce({sql_dot('u.embedding', 'p.embedding')}, 0.0) AS score
FROM iwn i LEFT JOIN uvec u ON u.id = i.user_id LEFT JOIN pvec p ON p.id = i.post_id""")

cte("topk", ["uvec", "pvec"], f"""
SELECT user_id, CAST(rank AS INTEGER) AS rank, post_id, score FROM (
  SELECT user_id, post_id, score,
         row_number() OVER (PARTITION BY user_id ORDER BY score DESC, post_id) AS rank
  FROM (SELECT u.id AS user_id, p.id AS post_id, {sql_dot('u.embedding', 'p.embedding')} AS score
        FROM uvec u, pvec p))
WHERE rank <= 10""")

cte("scaled_lf", ["login_frequency"], scale_sql("login_frequency", "uid", ["login_frequency"]))
cte("scaled_posts", ["post_table"], scale_sql("post_table", "po_id", POST_DENSE := [
    "post_length", "vote_count", "upvote_count", "view_count", "comment_count",
    "avg_time_viewed", "ctr"]))


def _f(expr: str) -> str:
    return f"CAST(coalesce(round(CAST({expr} AS DOUBLE), 6), 0.0) AS FLOAT)"


cte("user_dense", ["user_counts", "scaled_lf"], f"""
SELECT c.uid, [{_f('c.viewed_posts')}, {_f('c.upvoted_posts')}, {_f('c.commented_posts')},
               {_f('s.login_frequency')}] AS user_dense
FROM user_counts c JOIN scaled_lf s USING (uid)""")

cte("post_dense", ["scaled_posts"], "SELECT po_id, [" + ", ".join(_f(c) for c in POST_DENSE)
    + "] AS post_dense FROM scaled_posts")

def _or_zeros(expr: str, width: str) -> str:
    return f"coalesce({expr}, list_resize(CAST([] AS FLOAT[]), {width}, 0.0::FLOAT))"


cte("examples", ["iwn", "uvec", "pvec", "user_dense", "post_dense"], f"""
SELECT i.user_id, i.post_id, i.interaction_type, i.weight, CAST(i.weight > 0 AS INTEGER) AS label,
       CAST(u.id IS NOT NULL AS INTEGER) AS has_user_vector, CAST(p.id IS NOT NULL AS INTEGER) AS has_post_vector,
       {_or_zeros('u.embedding', '(SELECT max(len(embedding)) FROM uvec)')} AS user_embedding,
       {_or_zeros('ud.user_dense', '4')} AS user_dense,
       {_or_zeros('p.embedding', '(SELECT max(len(embedding)) FROM pvec)')} AS post_embedding,
       {_or_zeros('pd.post_dense', '7')} AS post_dense
FROM iwn i LEFT JOIN uvec u ON u.id = i.user_id LEFT JOIN user_dense ud ON ud.uid = i.user_id
LEFT JOIN pvec p ON p.id = i.post_id LEFT JOIN post_dense pd ON pd.po_id = i.post_id""")

# ---- held-out split ----------------------------------------------------------------
cte("split", ["iwn"], """
SELECT i.*, CASE WHEN weight > 0 THEN coalesce(rn <= 2, false)
                 ELSE coalesce(((user_id * 31 + post_id * 17) % 5 + 5) % 5 = 0, false) END AS held_out
FROM iwn i LEFT JOIN (
  SELECT event_id AS held, row_number() OVER (
    PARTITION BY user_id ORDER BY interaction_time DESC NULLS LAST, event_id DESC) AS rn
  FROM iwn WHERE weight > 0) ON held = event_id""")

cte("retrieval_ce", ["weighted", "uvec", "pvec"], f"""
SELECT batch, event_id, weight, m + ln(sum(exp(l - m))) - any_value(diag) AS ce FROM (
  SELECT a.batch, a.event_id, a.weight, l, diag, max(l) OVER (PARTITION BY a.batch, a.event_id) AS m FROM (
    SELECT a.batch, a.event_id, a.weight, {sql_dot('a.u', 'b.p')} AS l, {sql_dot('a.u', 'a.p')} AS diag
    FROM (SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 256 AS batch FROM (
            SELECT i.event_id, i.weight, u.embedding AS u, p.embedding AS p
            FROM weighted i JOIN uvec u ON u.id = i.user_id JOIN pvec p ON p.id = i.post_id
            WHERE i.weight > 0)) a
    JOIN (SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 256 AS batch FROM (
            SELECT i.event_id, p.embedding AS p
            FROM weighted i JOIN uvec u ON u.id = i.user_id JOIN pvec p ON p.id = i.post_id
            WHERE i.weight > 0)) b ON a.batch = b.batch) a)
GROUP BY batch, event_id, weight, m""")
