"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.runtime import materialize, value_bytes

#: Words are runs of anything but ASCII white space.
GAPS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Largest table, in bytes of its values, that these operators broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, GAPS), lambda w: w != "")


def broadcast_if_small(stored: DataFrame, flat: DataFrame | None = None) -> DataFrame:
    """``stored`` marked for broadcast if the values of ``flat`` (itself by default) fit.

    Beyond the limit the table is returned as it is, and Spark joins by shuffle.
    """
    fits = value_bytes(stored if flat is None else flat) <= BROADCAST_BYTES
    return F.broadcast(stored) if fits else stored


__all__ = ["BROADCAST_BYTES", "GAPS", "WORD", "broadcast_if_small", "let", "materialize", "table", "words_of"]
