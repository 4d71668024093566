"""Sinks of the metadata table and the dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusloom.sinks.avro import write_avro


def write_metadata(metadata: DataFrame, path: str, fmt: str = "parquet", mode: str = "error") -> None:
    """Metadata table in a format of Spark's, or with ``fmt="avro"`` as Avro container files."""
    if fmt == "avro":
        write_avro(metadata, path, mode, name="EmailMetadata")
        return
    metadata.write.format(fmt).mode(mode).save(path)


def write_dictionary(dictionary: DataFrame, path: str, mode: str = "error") -> None:
    """Tab-separated ``id, word, occurrences``, sorted by id."""
    (
        dictionary.select("id", "word", "occurrences")
        .orderBy("id")
        .write.mode(mode)
        .option("sep", "\t")
        .option("quote", "")
        .csv(path)
    )
