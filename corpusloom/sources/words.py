"""Sources of words: stop-word files and dictionary files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """Distinct whitespace-separated words of a text file: ``word STRING``."""
    words = spark.read.text(path).select(F.explode(F.split("value", r"\s+")).alias("word"))
    return words.where("word <> ''").distinct()


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated dictionary file: ``id INT, word STRING, occurrences LONG``."""
    return (
        spark.read.schema("id int, word string, occurrences long")
        .option("sep", "\t")
        .option("quote", "")
        .csv(path)
    )
