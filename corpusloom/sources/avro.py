"""Avro container files as tables."""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.functions.avro import blocks, read_header, reader, spark_schema

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes in which a file's header should lie; a file with a longer one is read whole for it.
HEADER_BYTES = 1 << 16


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all files below ``path``, with the schema that the first one declares.

    A task reads whole files, one at a time, and gives the rows of each block as a batch.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    first = files.where("length > 0").orderBy("path").limit(1)
    start = first.select(F.substring("content", 1, HEADER_BYTES).alias("start")).head()
    if start is None:
        raise ValueError(f"no Avro files below {path}")
    try:
        schema = spark_schema(read_header(io.BytesIO(bytes(start[0])))[0])
    except (IndexError, KeyError):
        schema = spark_schema(read_header(io.BytesIO(bytes(first.select("content").head()[0])))[0])
    arrow = to_arrow_schema(schema)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = io.BytesIO(content.as_py())
                own, codec, sync = read_header(data)
                readers = [reader(field["type"]) for field in own["fields"]]
                place = {field["name"]: i for i, field in enumerate(own["fields"])}
                for count, records in blocks(data, codec, sync):
                    rows = [[get(records) for get in readers] for _ in range(count)]
                    columns = [pa.array([r[place[f.name]] for r in rows], f.type) for f in arrow]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return files.where("length > 0").select("content").mapInArrow(decode, schema)
