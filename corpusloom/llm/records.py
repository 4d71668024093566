"""Token ids as files of length-delimited binary records, with an offset index.

A record is framed like this, all numbers little-endian:

    length of the payload  uint64
    masked checksum of the length  uint32
    payload
    masked checksum of the payload  uint32
    end mark  0x0A

The checksum is CRC-32, rotated right by 15 bits plus a constant, so that a checksum over
data that hold checksums stays meaningful.  A payload is the document id (int64), one byte
of flags (1: the id is null; 2: ids of 32 bits instead of 16) and the token ids.

Documents are range-partitioned and sorted by id, each task writes its frames through
Spark's writer - any store Spark reaches will do - and a file holds a bounded number of
records.  The index (file, offset, length, and what the payload says) is a table of its own,
made by reading the files back and checking both sums; shuffled reads seek by it.

Null texts count as empty and hold the end id alone; null ids come first; rows of one id are
kept all, in no fixed order among themselves; an empty table writes files without records.
"""

from __future__ import annotations

import os
import struct
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import broadcast_if_small, materialize
from corpusloom.llm.worker import gathered, kept, sliced
from corpusloom.runtime import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

END_ID = 2

#: Records of a file; a reading task holds one file.
FILE_RECORDS = 8192

#: Words whose ids a Python worker keeps, about 150 MB; a full cache keeps the slice's own.
CACHED_WORDS = 3 << 18

#: Characters beyond those whose lower case is one other character and needs no composing.
_OTHER = r"[^\x{0}-\x{12F}\x{131}-\x{24F}]"

MASK_DELTA = 0xA282EAD8
_HEAD = "<QI"
_DOC = "<qB"
_SUM = "<I"
_NULL_ID, _WIDE = 1, 2


def masked_checksum(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """A framed record without its end mark, which the line writer adds."""
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack(_SUM, masked_checksum(length)), payload, struct.pack(_SUM, masked_checksum(payload))))


def records(content: bytes | memoryview) -> Iterator[tuple[int, memoryview]]:
    """``offset, payload`` of every record of a file, sums checked."""
    view, at = memoryview(content), 0
    while at < len(view):
        length, said = struct.unpack_from(_HEAD, view, at)
        if masked_checksum(view[at : at + 8]) != said:
            raise ValueError(f"length of the record at byte {at} is damaged")
        begin = at + struct.calcsize(_HEAD)
        payload = view[begin : begin + length]
        if masked_checksum(payload) != struct.unpack_from(_SUM, view, begin + length)[0]:
            raise ValueError(f"record at byte {at} is damaged")
        yield at, payload
        at = begin + length + struct.calcsize(_SUM) + 1


def parsed(payload: memoryview) -> tuple[int | None, np.ndarray]:
    """Document id and token ids of a payload."""
    doc, flags = struct.unpack_from(_DOC, payload)
    ids = np.frombuffer(payload[struct.calcsize(_DOC) :], "<u4" if flags & _WIDE else "<u2")
    return (None if flags & _NULL_ID else doc), ids


class WordEncoder:
    """Texts to ids; the library encodes every new word once.

    Tokens never reach across a space or line feed, so a text's ids are those of its words
    in a row, and the distinct words of a batch are enough.  The vocabulary lowers its input
    and keeps letters and marks apart, so texts of Latin letters are lowered first, and a
    final stop or comma is taken off a word.  Other texts, and those that might spell a
    special token, keep their words as they are.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.kind = np.dtype("<u4" if self.library.get_vocab_size() > 1 << 16 else "<u2")
        self.known: dict[str, bytes] = {"": b""}

    def _lookup(self, words: list[str]) -> list[bytes]:
        """Packed ids of distinct words."""
        known = self.known
        missing = [w for w in words if w not in known]
        if len(known) + len(missing) > CACHED_WORDS:
            known = {w: known[w] for w in words if w in known}
        for a in range(0, len(missing), 4096):
            some = missing[a : a + 4096]
            code = "I" if self.kind.itemsize == 4 else "H"
            for word, found in zip(some, self.library.encode_batch_fast(some, add_special_tokens=False)):
                known[word] = array(code, found.ids).tobytes()
        result = [known[w] for w in words]
        if len(known) <= CACHED_WORDS:
            self.known = known
        return result

    def _table(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        packed = self._lookup(words.to_pylist())
        length = np.array([len(p) for p in packed], np.int64) // self.kind.itemsize
        return np.frombuffer(b"".join(packed), self.kind), np.cumsum(length) - length, length

    def _encode(self, texts: pa.Array, plain: bool) -> list[np.ndarray]:
        if plain:
            texts = pc.utf8_lower(texts)
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        names = words.dictionary
        if plain:
            stopped = pc.match_substring_regex(names, r"^\pL+[.,]$")
            heads = pc.if_else(stopped, pc.utf8_slice_codeunits(names, 0, -1), names)
            tails = pc.if_else(stopped, pc.utf8_slice_codeunits(names, -1), "")
            # a row of head and tail for every name
            parts = pa.concat_arrays([heads, tails]).dictionary_encode()
            table = self._table(parts.dictionary)
            own = parts.indices.to_numpy().reshape(2, -1).T.ravel()
            flat, n = gathered(*table, own)
            length = n.reshape(-1, 2).sum(axis=1)
            start = np.cumsum(length) - length
        else:
            flat, start, length = self._table(names)
        ids, n = gathered(flat, start, length, words.indices.to_numpy())
        before = np.concatenate([[0], np.cumsum(n)])
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        return np.split(ids, before[offsets[1:-1]]) if len(texts) else []

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of every text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        other = pc.or_(pc.match_substring_regex(texts, _OTHER), pc.match_substring(texts, "<|"))
        found: list[np.ndarray] = [np.zeros(0, self.kind)] * len(texts)
        for chosen, plain in ((pc.invert(other), True), (other, False)):
            for i, ids in zip(np.flatnonzero(chosen), self._encode(texts.filter(chosen), plain)):
                found[i] = ids
        return found


def _frames(path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(f"words of {path}", lambda: WordEncoder(path))
        end = np.array([end_id], encoder.kind).tobytes()
        flag = _WIDE if encoder.kind.itemsize == 4 else 0
        for batch in sliced(batches, 1):
            docs = batch.column(0).to_pylist()
            framed = [
                frame(struct.pack(_DOC, d or 0, flag | (_NULL_ID if d is None else 0)) + ids.tobytes() + end)
                for d, ids in zip(docs, encoder.encode(batch.column(1)))
            ]
            yield pa.RecordBatch.from_arrays([pa.array(framed, pa.binary())], ["frame"])

    return write


def write_records(
    docs: DataFrame, folder: str, vocabulary: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> None:
    """Encode ``text`` by the vocabulary file, append ``end_id`` and write records in ``key`` order."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    placed = rows.repartitionByRange(F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first())
    frames = placed.mapInArrow(_frames(vocabulary, end_id), "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("maxRecordsPerFile", FILE_RECORDS).text(
        folder
    )


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["file", "offset", "length", "key", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows, start = [], 0
            for offset, payload in records(content.as_buffer()):
                key, ids = parsed(payload)
                rows.append((offset, len(payload), key, start, len(ids), zlib.crc32(ids.astype("<u4"))))
                start += len(ids)
            if not rows:
                continue
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([pa.array([file] * len(rows)), *columns], names)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select("path", "content")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """``file, offset, length, key, start, n_tokens, ids_crc32`` of all records, from the files.

    ``start`` counts the ids of all records before, over all files in order.
    """
    schema = "file string, offset long, length long, key long, start long, n_tokens long, ids_crc32 long"
    own = materialize(_files(spark, folder).mapInArrow(_listed, schema), "record-index")
    files = own.groupBy("file").agg(F.sum("n_tokens").alias("n"), F.min("key").alias("first"), F.max("key").alias("last"))
    order = Window.orderBy(F.col("first").asc_nulls_first(), F.col("last").asc_nulls_first(), "file")  # a row per file
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = materialize(files.select("file", before.alias("base")), "record-bases")
    placed = own.join(broadcast_if_small(bases), "file")
    return placed.withColumn("start", F.col("start") + F.col("base")).drop("base")


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(1):
            rows = [parsed(payload) for _, payload in records(content.as_buffer())]
            keys = pa.array([k for k, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array([ids.tolist() for _, ids in rows], pa.list_(pa.int32()))], ["key", "ids"]
            )


def read_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """``key, ids`` of all records."""
    return _files(spark, folder).mapInArrow(_sequences, "key long, ids array<int>")


def tokens_by_document(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the records of ``docs`` to the scratch folder; their index, read from the files."""
    folder = scratch_path(docs.sparkSession, "token-records")
    write_records(docs, folder, vocabulary, key, text)
    return read_index(docs.sparkSession, folder)
