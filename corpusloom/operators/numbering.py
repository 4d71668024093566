"""Dense 0-based numbers for rows, without a window over the whole table."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import runtime

_POSITION = "__position"
_PART_BITS = 33  # monotonically_increasing_id: part number above, row number below


def dense_index(df: DataFrame, *order: Column | str, name: str = "id", kind: str = "long") -> DataFrame:
    """Add ``name`` = 0, 1, 2, ... in the given order, or in storage order.

    Rows are numbered within their partition, the numbered rows are written, and
    the start of every partition is added.  With an order the partitions are
    sorted ranges (give a total order to make the numbers repeatable); without
    one no row is moved.  Only the row counts of the partitions, one number each,
    come to the driver and are broadcast.
    """
    return stored_index(df, *order, name=name, kind=kind)[0]


def stored_index(df: DataFrame, *order: Column | str, name: str = "id", kind: str = "long") -> tuple[DataFrame, str]:
    """What ``dense_index`` gives, and the path of the table it is read from."""
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed, path = runtime.store(df.withColumn(_POSITION, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(_POSITION, _PART_BITS)
    sizes = sorted(placed.groupBy(part).count().collect())  # one row per partition
    firsts = accumulate((n for _, n in sizes), initial=0)
    starts = df.sparkSession.createDataFrame(
        [(p, first) for (p, _), first in zip(sizes, firsts)], "part long, start long"
    )
    number = F.col("start") + F.col(_POSITION).bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    if kind == "int":  # also outside ANSI mode a number too large is an error, not another number
        too_large = F.raise_error(F.lit("more rows than an int can number")).cast("long")
        number = F.when(number < (1 << 31), number).otherwise(too_large)
    numbered = placed.join(F.broadcast(starts), part == F.col("part")).select(
        number.cast(kind).alias(name), *(F.col(c) for c in df.columns)
    )
    return numbered, path
