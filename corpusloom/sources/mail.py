"""Sources of raw documents: ``path STRING, document STRING``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_HASH_SPACE = 1 << 32


def read_sequence_file(spark: SparkSession, path: str) -> DataFrame:
    """Sequence file of (path, text) pairs.

    Spark has no DataFrame reader for this format, so the pairs pass through
    Python once.  Read it once at ingestion and keep the result as parquet.
    """
    pairs = spark.sparkContext.sequenceFile(path)
    return spark.createDataFrame(pairs, "path string, document string", verifySchema=False)


def read_mail_directory(spark: SparkSession, path: str) -> DataFrame:
    """Directory of whole files, one document per file, searched recursively."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("document"))
    )


def sample_documents(df: DataFrame, fraction: float = 0.01, seed: int | None = None) -> DataFrame:
    """Random sample without replacement.  Take it before any costly step."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_by_hash(df: DataFrame, key: Column, fraction: float = 0.01) -> DataFrame:
    """Sample decided by each key alone: the same keys in every run and layout."""
    leading = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")
    return df.where(leading < F.lit(int(fraction * _HASH_SPACE)))
