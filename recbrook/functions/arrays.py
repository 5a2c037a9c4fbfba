"""Array-column functions with warehouse NULL rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def prepend(head: Column, arr: Column) -> Column:
    """``ARRAY_CONCAT([head], arr)``: NULL when ``arr`` is NULL."""
    return F.concat(F.array(head), arr)


def array_length(arr: Column) -> Column:
    """``ARRAY_LENGTH``: NULL on NULL (Spark's ANSI ``size``), as bigint."""
    return F.when(arr.isNotNull(), F.size(arr)).cast("bigint")


def array_sum(arr: Column) -> Column:
    """Sum of the elements, NULL elements skipped; 0.0 for an empty array."""
    return F.aggregate(arr, F.lit(0.0).cast("double"),
                       lambda acc, x: acc + F.coalesce(x.cast("double"), F.lit(0.0)))


def array_mean_or_zero(arr: Column) -> Column:
    """``IF(ARRAY_LENGTH(a) > 0, SUM(a) / ARRAY_LENGTH(a), 0)``.

    NULL elements count in the divisor but not in the sum; an empty or
    NULL array gives 0.
    """
    n = F.size(arr)
    return F.when(arr.isNotNull() & (n > 0), array_sum(arr) / n).otherwise(F.lit(0.0))


def join_text(arr: Column) -> Column:
    """``' '.join(x) if x is a list else ''``; NULL elements are skipped."""
    return F.coalesce(F.array_join(arr, " "), F.lit(""))


def empty_if_null(arr: Column, element_type: str = "string") -> Column:
    return F.coalesce(arr, F.array().cast(f"array<{element_type}>"))


def ordered_values(sorted_structs: Column, field: str) -> Column:
    """Project one field from an array of structs that was sorted by a
    leading ordering field (``sort_array(collect_list(struct(k, v)))``)."""
    return F.transform(sorted_structs, lambda s: s[field])
