"""User operators: interaction counts, login intervals and frequency,
recent titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import ordered_values
from .ordering import _materialise, _ranged
from ..functions.time import adjacent_gaps_seconds, geometric_mean_positive

COUNTED_TYPES = {"viewed_posts": "view", "upvoted_posts": "upvote",
                 "commented_posts": "comment"}
RECENT_TITLES = 10


def interaction_counts_by_user(interactions: DataFrame) -> DataFrame:
    """Three filtered ``COUNT(post_id)`` subqueries as one conditional
    aggregate: one scan, one shuffle, partial counts map-side."""
    t = F.col("interaction_type")
    return (interactions.filter(t.isin(*COUNTED_TYPES.values()))
            .groupBy(F.col("user_id").alias("uid"))
            .agg(*[F.count(F.when(t == v, F.col("post_id"))).alias(k)
                   for k, v in COUNTED_TYPES.items()]))


def user_interaction_counts(user_keys: DataFrame, interactions: DataFrame) -> DataFrame:
    """Counts left-joined to users; no interactions gives 0, not NULL."""
    return (user_keys.select("uid").join(interaction_counts_by_user(interactions), "uid", "left")
            .na.fill(0, subset=list(COUNTED_TYPES)))


def login_intervals(users: DataFrame) -> DataFrame:
    """One row per adjacent login pair: (uid, i, interval seconds).

    Computed inside each user's ``login_times`` array, then exploded: the
    array already sits in one row, so this needs no shuffle and no window.
    """
    return users.select("uid", F.posexplode(adjacent_gaps_seconds("login_times"))
                        .alias("i", "interval"))


def user_login_frequency(users: DataFrame) -> DataFrame:
    """Geometric mean of a user's login intervals (larger = rarer logins).

    Users with fewer than two logins are not updated and stay NULL; a user
    whose intervals are all zero gets 0 (``COALESCE(..., 0)``).
    """
    return users.select("uid", login_frequency().alias("login_frequency"))


def login_frequency(times: str = "login_times"):
    """Column form of ``user_login_frequency``."""
    gaps = adjacent_gaps_seconds(times)
    return F.when(F.size(times) >= 2, F.coalesce(geometric_mean_positive(gaps), F.lit(0.0)))


def login_gaps(logins: DataFrame) -> DataFrame:
    """One row per adjacent login pair of a user: (uid, i, interval seconds),
    from one row per login (uid, ts); rows without either are left out.

    Logins are put in (uid, ts) order over range partitions, so the logins of
    one user with a third of all rows lie in many of them.  ``lag`` runs inside
    a partition; the first row of each takes its predecessor from a table of
    every partition's last row (one row a partition, as are the offsets)."""
    ranged = _ranged(logins.filter(F.col("uid").isNotNull() & F.col("ts").isNotNull()).select("uid", "ts"),
                     [F.col("uid"), F.col("ts")], None)
    inside = Window.partitionBy("_pid").orderBy("uid", "ts")
    local = _materialise(ranged.withColumns({
        "_before": F.lag(F.struct("uid", "ts")).over(inside), "_n": F.row_number().over(inside)}))
    order = Window.orderBy("_pid")
    ends = (local.groupBy("_pid").agg(F.max(F.struct("uid", "ts")).alias("_last"), F.count(F.lit(1)).alias("_rows"))
            .select("_pid", F.lag("_last").over(order).alias("_edge"),
                    (F.sum("_rows").over(order) - F.col("_rows")).alias("_off")))
    placed = (local.join(F.broadcast(ends), "_pid")
              .select("uid", "ts", F.when(F.col("_n") == 1, F.col("_edge")).otherwise(F.col("_before")).alias("_b"),
                      (F.col("_off") + F.col("_n")).alias("_at")))
    same = F.coalesce(F.col("_b.uid") == F.col("uid"), F.lit(False))
    first = placed.filter(~same).select(F.col("uid").alias("_u"), F.col("_at").alias("_first"))  # a row a user
    return (placed.filter(same).join(first, F.col("uid") == F.col("_u"))
            .select("uid", (F.col("_at") - F.col("_first") - 1).cast("int").alias("i"),
                    F.expr("timestampdiff(SECOND, _b.ts, ts)").alias("interval")))


def login_frequency_by_user(logins: DataFrame) -> DataFrame:
    """(uid, login_frequency) of users with two logins or more, from one row
    per login: the geometric mean of the positive gaps, 0 without one; sums
    are partial per task."""
    gap = F.when(F.col("interval") > 0, F.col("interval"))
    mean = F.exp(F.try_divide(F.sum(F.ln(gap)), F.count(gap)))
    return login_gaps(logins).groupBy("uid").agg(F.coalesce(mean, F.lit(0.0)).alias("login_frequency"))


def login_frequency_of(user_keys: DataFrame, logins: DataFrame) -> DataFrame:
    """The same for every user; NULL with fewer than two logins."""
    return user_keys.select("uid").join(login_frequency_by_user(logins), "uid", "left")


def recent_titles_by_user(interactions: DataFrame, post_text: DataFrame,
                          k: int = RECENT_TITLES) -> DataFrame:
    """``ARRAY_AGG(title ORDER BY interaction_time DESC LIMIT k)`` per user.

    NULL times (appended negatives) sort last; ties break on post id, and
    rows tied on both carry the same title.  ``row_number() <= k`` lets
    Spark insert a partial per-user limit before the shuffle, so a user
    with a third of all rows ships at most k rows per task.  Only the rows
    kept are joined to the titles; before, a semi join on the ids drops
    interactions with unknown posts.
    """
    titles = post_text.select(F.col("po_id").alias("post_id"), "title")
    known = interactions.select("user_id", "post_id", "interaction_time").join(
        titles.select("post_id"), "post_id", "left_semi")
    w = Window.partitionBy("user_id").orderBy(F.col("interaction_time").desc_nulls_last(),
                                              F.col("post_id").asc())
    top = (known.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k)
           .join(titles, "post_id"))
    return (top.groupBy(F.col("user_id").alias("uid"))
            .agg(F.sort_array(F.collect_list(F.struct("rn", "title"))).alias("_t"))
            .select("uid", ordered_values(F.col("_t"), "title").alias("recent_titles")))


def user_recent_titles(user_keys: DataFrame, interactions: DataFrame,
                       post_text: DataFrame, k: int = RECENT_TITLES) -> DataFrame:
    """Recent titles for every user; NULL for users with no rows."""
    return user_keys.select("uid").join(recent_titles_by_user(interactions, post_text, k),
                                        "uid", "left")
