"""Tables as Avro container files, through Spark's own writer."""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.avro import CODECS, SYNC_BYTES, avro_schema, block, header, writer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of records after which a block ends.
BLOCK_BYTES = 1 << 16


def write_avro(df: DataFrame, path: str, mode: str = "error", codec: str = "deflate", name: str = "Row") -> None:
    """Write flat columns and arrays as Avro files, one per partition that Spark writes.

    The rows of Spark's line writer are the header and the blocks of a file: the sync mark ends
    with the line feed that the writer adds.  So files go to any store Spark writes to, and are
    committed as Spark's files are.
    """
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {', '.join(CODECS)}, not {codec!r}")
    schema = avro_schema(df.schema, name)
    sync = hashlib.sha256(json.dumps(schema).encode()).digest()[: SYNC_BYTES - 1] + b"\n"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writers = [writer(field["type"]) for field in schema["fields"]]

        def row(data: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([data[:-1]], pa.binary())], ["value"])

        yield row(header(schema, codec, sync))
        records, count = bytearray(), 0
        for batch in batches:
            for values in zip(*(column.to_pylist() for column in batch.columns)):
                for put, value in zip(writers, values):
                    put(value, records)
                count += 1
                if len(records) >= BLOCK_BYTES:
                    yield row(block(count, bytes(records), codec, sync))
                    records, count = bytearray(), 0
        if count:
            yield row(block(count, bytes(records), codec, sync))

    rows = df.mapInArrow(encode, "value binary").select(F.col("value").cast("string"))
    rows.write.mode(mode).option("compression", "none").text(path)
