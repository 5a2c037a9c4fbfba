"""Collab operators: team members and per-user project titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import prepend
from ..functions.text import tokenize


def collab_members(collabs: DataFrame) -> DataFrame:
    """Owner prepended to the team, derived (not overwritten) so a rerun
    gives the same array.  NULL team gives NULL members."""
    return collabs.withColumn("all_team_uids", prepend(F.col("owner_uid"), F.col("team_uids")))


def project_titles_by_user(collabs: DataFrame) -> DataFrame:
    """Titles of every collab a user is a member of; NULL for none.

    ``uid IN UNNEST(team)`` is rewritten as explode + equi-join, so Spark
    plans a hash join on uid instead of a nested loop over
    ``array_contains``.  Members are made distinct per collab first so a
    uid listed twice still matches once.
    """
    return member_titles(collabs).groupBy("uid").agg(
        F.sort_array(F.collect_list("title")).alias("project_titles"))


def member_titles(collabs: DataFrame) -> DataFrame:
    """(uid, title) per member of each collab."""
    return collab_members(collabs).select(
        F.explode(F.array_distinct("all_team_uids")).alias("uid"), "title")


def leading_titles(collabs: DataFrame, tokens: int) -> DataFrame:
    """(uid, project_titles): a user's first ``tokens`` titles that have a
    token, which hold the first ``tokens`` tokens of all its titles, so no
    user's titles are collected whole."""
    w = Window.partitionBy("uid").orderBy("title")
    first = (member_titles(collabs).filter(F.size(tokenize(F.col("title"))) > 0)
             .withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= tokens))
    return first.groupBy("uid").agg(F.sort_array(F.collect_list("title")).alias("project_titles"))


def user_project_titles(user_keys: DataFrame, collabs: DataFrame) -> DataFrame:
    """Project titles for every user; NULL for users in no collab."""
    return user_keys.select("uid").join(project_titles_by_user(collabs), "uid", "left")
