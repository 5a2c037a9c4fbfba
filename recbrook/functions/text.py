"""Text functions: tokenising and id encoding as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Special token ids, in id order.
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 1, 2, 3
FIRST_WORD_ID = 4
# A token is a maximal run of Unicode letters or digits, lower-cased.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokenize(text: Column) -> Column:
    """Whole-text tokens: lower-case, split on non letter/digit runs.
    Empty pieces (leading or trailing separators) are dropped with
    ``array_remove``, a compiled function, rather than a lambda."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), TOKEN_SPLIT), "")


def pad_ids(ids: Column, width: Column) -> Column:
    """Right-pad with ``PAD_ID`` (or cut) to exactly ``width`` ids."""
    return F.slice(F.concat(ids, F.array_repeat(F.lit(PAD_ID).cast("bigint"), width)), 1, width)
