"""Session helpers: the shared scratch folder, intermediate tables, checked broadcasts.

Intermediate results that are read more than once are written as tables below
the folder the session names in ``spark.checkpoint.dir``.  A written table cuts
the lineage and outlives lost executors, and its size can be asked cheaply
before it is broadcast.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Whether Spark drops the shuffle files of a query when the query has ended.
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Largest table, in bytes of its values, that is ever sent to every executor.
BROADCAST_LIMIT_BYTES = 256 * 1024 * 1024

#: Inputs of fewer partitions, at most some gigabytes, are spread over the cores.
SPREAD_BELOW_PARTITIONS = 64

_ROW_OVERHEAD_BYTES = 32


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by the driver and all executors.

    The session's ``spark.checkpoint.dir`` is used.  Only a local-mode session
    without that setting gets a temporary folder of its own; on a cluster a
    missing setting is an error, as a machine-local folder would be unreadable
    for the other executors.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if context.master.split("[")[0] != "local":
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="corpusloom-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/corpusloom/{app}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``checkpoint()`` usable, e.g. for the lineage of iterative training."""
    root = scratch_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a small input one partition per core before costly work on its rows.

    A small file, or one with a single row group, would keep all but one core
    idle.  Inputs of many partitions are left where they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= min(cores, SPREAD_BELOW_PARTITIONS):
        return df
    return df.repartition(cores, *keys)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Nothing reads the shuffle files of a write again: Spark drops those of the writes within at their end."""
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_CONF)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def store(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a parquet table in the scratch folder; a scan of it, and its path."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a parquet table in the scratch folder and return a scan of it."""
    return store(df, label)[0]


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no plan will read again."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def value_bytes(df: DataFrame) -> int:
    """Bytes needed to hold a flat table in memory (strings by their real length)."""
    per_row = F.lit(_ROW_OVERHEAD_BYTES)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            per_row = per_row + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            raise TypeError(f"{field.name}: only flat tables can be sized")
        else:
            per_row = per_row + F.lit(8)
    return df.agg(F.sum(per_row.cast("long"))).first()[0] or 0


def fits_broadcast(df: DataFrame, limit_bytes: int | None = None) -> bool:
    """Whether a table (best a materialized one) is small enough to broadcast."""
    limit = BROADCAST_LIMIT_BYTES if limit_bytes is None else limit_bytes
    return value_bytes(df) <= limit
