"""Small array helpers used by the column expressions of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def value_counts(items: Column) -> Column:
    """``array<struct<word, cnt>>`` of an array's values, sorted by value.

    Works inside one row: the array is sorted and the lengths of its runs are
    taken, so a document's counts need neither an explode nor a shuffle.
    """

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.transform(
                ordered,
                lambda item, i: F.when((i == 0) | (item != F.get(ordered, i - 1)), i),
            ),
            lambda i: i.isNotNull(),
        )
        return let(
            starts,
            lambda begin: F.transform(
                begin,
                lambda at, k: F.struct(
                    F.get(ordered, at).alias("word"),
                    (F.coalesce(F.get(begin, k + 1), F.size(ordered)) - at).alias("cnt"),
                ),
            ),
        )

    return let(F.sort_array(items), runs)


def without_trailing_empty(parts: Column) -> Column:
    """Drop empty strings from the end of a split result, unless nothing was split."""
    return F.when(F.size(parts) == 1, parts).otherwise(
        F.slice(
            parts,
            F.lit(1),
            F.array_max(F.transform(parts, lambda p, i: F.when(p == "", -1).otherwise(i))) + 1,
        )
    )


def explode_values(df: DataFrame, array: Column | str, name: str, *keep: str) -> DataFrame:
    """One row per element of an array without nulls, beside the columns to ``keep``.

    A plain ``explode`` makes Spark test first that the array is not empty, which
    evaluates a costly array expression once more for each test.  The outer form
    has no such test; its rows for empty arrays are dropped right after it.
    """
    exploded = df.select(*keep, F.explode_outer(array).alias(name))
    return exploded.where(F.col(name).isNotNull())
