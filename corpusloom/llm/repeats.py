"""Long repeats, by a difference cover: bytes of any 200-byte string that starts elsewhere too.

A difference-cover hash match stands in for the recursion, the merge and the comparison of
prefixes of the full construction: nothing is ranked, there is one pass, and equal hashes stand
for equal bytes.  The order of suffixes beyond ``LENGTH`` bytes is of no interest here, so the difference-cover
construction is cut off at that depth, and names are hashes instead of ranks.

1. *Sampled tuples.*  ``COVER`` is a difference cover modulo ``MODULUS``: any two positions
   have a common shift below MODULUS that makes both sampled.  Tuples of ``TUPLE`` bytes at
   sampled positions are named, so equal strings of LENGTH = TUPLE + MODULUS - 1 bytes hold a
   pair of equal names, whatever their positions.
2. *First places, instead of recursion.*  Names are sorted; every position learns the first place of its
   name.  Neighbouring samples whose first places lie at one shift are chained: a chain that
   spans a string proves that the string also starts at the first place, which is told so.
3. *Remaining suffixes, instead of a merge.*  A start that is no part of such a chain, but has a repeated name at
   one of its shifts, is matched by the name of its whole string: equal neighbours in sorted
   order are repeats.  Chained starts need no name there, as an earlier equal start has one.

Names of a chunk of texts are sorted, made distinct, and packed before they are shuffled, a
few bytes each, so a string of a third of all rows costs one name per chunk.  Buckets of names
have a bounded size, chunks too; texts are moved once, compressed.  Names of tuples have 46
bits, and a chain needs several equal ones in step; names of whole strings have 62.

Null texts count as empty.  Texts are judged row by row, so repeated rows repeat each other.
Matches never cross texts.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.bagminhash import mix
from corpusloom.llm.worker import kept
from corpusloom.runtime import drop_path, materialize, store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 200

# A perfect difference set, every difference modulo 73 occurs once.
MODULUS = 73
COVER = (1, 2, 4, 8, 16, 32, 37, 55, 64)
TUPLE = LENGTH - MODULUS + 1

CHUNK_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20
PREFIX_BITS = 14  # of a name that its place in a packed list tells
NAME_BYTES, STRING_BYTES = 4, 6  # further bytes of a name

_U = np.uint64
_DOC, _TEXTS, _CLAIM, _STRING = range(4)  # kinds of rows between the steps
_ROW = "kind int, bucket int, chunk long, payload binary"


# --- hashing ----------------------------------------------------------------------


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for every byte, powers of an odd base, and their inverses, modulo 2^64."""

    def make(size: int):
        base = 0x9E3779B97F4A7C15
        inverse = pow(base, -1, 1 << 64)
        codes = mix(mix(np.arange(256, dtype=np.uint64)))
        up, down = (np.full(size, b, np.uint64) for b in (base, inverse))
        up[0] = down[0] = 1
        return codes, np.multiply.accumulate(up), np.multiply.accumulate(down)

    size = max(CHUNK_BYTES + 1, n)
    if size == CHUNK_BYTES + 1:
        return kept(f"powers of the repeat hash {size}", lambda: make(size))
    return make(size)


class Hasher:
    """Hashes of substrings of one chunk."""

    def __init__(self, data: np.ndarray) -> None:
        codes, powers, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes[data] * powers[: len(data)], out=self.sums[1:])

    def at(self, start: np.ndarray, length: int) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.inverse[start])


# --- chunks -----------------------------------------------------------------------


@dataclass
class Chunk:
    """Texts in a row; ``begin`` are their places in the chunk they were first put into."""

    keys: list[int | None]
    begin: np.ndarray
    length: np.ndarray
    data: np.ndarray

    def packed(self) -> bytes:
        head = np.concatenate(
            [
                [len(self.keys)],
                [k or 0 for k in self.keys],
                [k is None for k in self.keys],
                self.begin,
                self.length,
                [len(self.data)],
            ]
        ).astype("<i8")
        body = pa.Codec("zstd", compression_level=6).compress(self.data.tobytes(), asbytes=True)
        return head.tobytes() + body

    @staticmethod
    def unpacked(payload: bytes) -> Chunk:
        n = int(np.frombuffer(payload, "<i8", 1)[0])
        head = np.frombuffer(payload, "<i8", 2 + 4 * n)[1:]
        keys = [None if gone else k for k, gone in zip(head[:n].tolist(), head[n : 2 * n].tolist())]
        data = pa.Codec("zstd").decompress(payload[8 * (2 + 4 * n) :], decompressed_size=int(head[-1]), asbytes=True)
        return Chunk(keys, head[2 * n : 3 * n], head[3 * n : 4 * n], np.frombuffer(data, np.uint8))

    def samples(self) -> np.ndarray:
        """Sampled positions, in order; those of a text count from its own start."""
        end = np.cumsum(self.length)
        found = []
        for stop, n in zip(end.tolist(), self.length.tolist()):
            if n >= LENGTH:
                own = np.add.outer(np.arange(0, n, MODULUS), np.array(COVER)).ravel()
                found.append(stop - n + own[own <= n - TUPLE])
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def part(self, chosen: np.ndarray) -> Chunk:
        end = np.cumsum(self.length)
        data = [self.data[end[i] - self.length[i] : end[i]] for i in chosen]
        joined = np.concatenate(data) if data else np.zeros(0, np.uint8)
        return Chunk([self.keys[i] for i in chosen], self.begin[chosen], self.length[chosen], joined)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row(keys: list, texts: list[bytes]) -> pa.RecordBatch:
        length = np.array([len(t) for t in texts], np.int64)
        chunk = Chunk(keys, np.cumsum(length) - length, length, np.frombuffer(b"".join(texts), np.uint8))
        return pa.RecordBatch.from_arrays(
            [pa.array([int(length.sum())]), pa.array([chunk.packed()], pa.binary())], ["n_bytes", "payload"]
        )

    keys: list[int | None] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = bytes(text.as_buffer()) if text.is_valid else b""
            if keys and size + len(data) > CHUNK_BYTES:
                yield row(keys, texts)
                keys, texts, size = [], [], 0
            keys.append(key)
            texts.append(data)
            size += len(data)
    if keys:
        yield row(keys, texts)


# --- packed lists of names ----------------------------------------------------------


def pack(names: np.ndarray, n_bytes: int, buckets: int, places: np.ndarray | None = None) -> list[tuple[int, bytes]]:
    """Sorted, distinct names (in the top bits) by bucket; the prefixes are stored as counts."""
    prefix = (names >> _U(64 - PREFIX_BITS)).astype(np.int64)
    width = (1 << PREFIX_BITS) // buckets
    edges = np.searchsorted(prefix, np.arange(0, (1 << PREFIX_BITS) + 1, width))
    rest = (names << _U(PREFIX_BITS)) >> _U(64 - 8 * n_bytes)
    rest = rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n_bytes]
    rows = []
    for b in np.flatnonzero(np.diff(edges)):
        lo, hi = edges[b], edges[b + 1]
        counts = np.bincount(prefix[lo:hi] - b * width, minlength=width)
        size = 1 if counts.max() < 256 else 4
        parts = [bytes([size]), np.int64(hi - lo).tobytes(), counts.astype(f"<u{size}").tobytes(), rest[lo:hi].tobytes()]
        if places is not None:
            parts.append(places[lo:hi].astype("<u4").view(np.uint8).reshape(-1, 4)[:, : _place_bytes(places)].tobytes())
            parts.append(bytes([_place_bytes(places)]))
        rows.append((int(b), b"".join(parts)))
    return rows


def _place_bytes(places: np.ndarray) -> int:
    return 3 if places.max(initial=0) < 1 << 24 else 4


def unpack(payload: bytes, n_bytes: int, bucket: int, buckets: int, placed: bool) -> tuple[np.ndarray, np.ndarray | None]:
    width = (1 << PREFIX_BITS) // buckets
    size, n = payload[0], int(np.frombuffer(payload, "<i8", 1, 1)[0])
    at = 9 + size * width
    counts = np.frombuffer(payload, f"<u{size}", width, 9)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :n_bytes] = np.frombuffer(payload, np.uint8, n * n_bytes, at).reshape(n, n_bytes)
    names = wide.view("<u8").ravel() << _U(64 - PREFIX_BITS - 8 * n_bytes)
    names |= np.repeat(bucket * width + np.arange(width), counts).astype(np.uint64) << _U(64 - PREFIX_BITS)
    if not placed:
        return names, None
    size = payload[-1]
    wide = np.zeros((n, 4), np.uint8)
    wide[:, :size] = np.frombuffer(payload, np.uint8, n * size, at + n * n_bytes).reshape(n, size)
    return names, wide.view("<u4").ravel().astype(np.int64)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    """A batch of ``kind, bucket, chunk, payload``."""
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    columns = [pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["kind", "bucket", "chunk", "payload"])


def _messages(told: pa.Table) -> list[tuple[int, int, bytes]]:
    """``kind, bucket, payload`` of what a chunk was told; a table without rows has no columns."""
    return list(zip(*(told[c].to_pylist() for c in ("kind", "bucket", "payload")))) if told.num_rows else []


def _truncated(names: np.ndarray, n_bytes: int) -> np.ndarray:
    low = _U(64 - PREFIX_BITS - 8 * n_bytes)
    return names >> low << low


def _tuple_names(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    samples = chunk.samples()
    return samples, _truncated(Hasher(chunk.data).at(samples, TUPLE), NAME_BYTES)


def _name_lists(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Distinct tuple names of every chunk, each with its first place."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk_id, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                samples, names = _tuple_names(Chunk.unpacked(payload))
                if len(names):
                    distinct, first = np.unique(names, return_index=True)
                    packed = pack(distinct, NAME_BYTES, buckets, samples[first])
                    yield _rows([(_STRING, b, chunk_id, p) for b, p in packed])

    return named


def _joined(table: pa.Table, n_bytes: int, buckets: int, placed: bool):
    """All names of a bucket sorted, with the list and the index they come from."""
    chunks = table["chunk"].to_pylist()
    order = sorted(range(len(chunks)), key=chunks.__getitem__)
    bucket, payloads = table["bucket"][0].as_py(), table["payload"]
    lists = [unpack(payloads[i].as_py(), n_bytes, bucket, buckets, placed) for i in order]
    names = np.concatenate([x for x, _ in lists])
    source = np.repeat(np.arange(len(lists)), [len(x) for x, _ in lists])
    index = np.concatenate([np.arange(len(x)) for x, _ in lists])
    places = np.concatenate([p for _, p in lists]) if placed else None
    by_name = np.argsort(names, kind="stable")  # lists are in chunk order, so a group's first is the lowest
    names, source, index = names[by_name], source[by_name], index[by_name]
    new = np.append(True, names[1:] != names[:-1])
    start = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    shared = np.diff(np.append(start, len(names)))[group] > 1
    return [chunks[i] for i in order], bucket, source, index, start[group], shared, None if places is None else places[by_name]


def _owners(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """For every list the names that other chunks hold too, with the first place of each."""

    def found(table: pa.Table) -> pa.Table:
        chunks, bucket, source, index, first, shared, places = _joined(table, NAME_BYTES, buckets, True)
        ids = np.array(chunks, np.int64)
        at = np.flatnonzero(shared)
        at = at[np.lexsort((index[at], source[at]))]
        rows = []
        ends = np.searchsorted(source[at], np.arange(len(chunks) + 1))
        for i, chunk in enumerate(chunks):
            own = at[ends[i] : ends[i + 1]]
            if len(own):
                parts = (
                    index[own].astype("<u4"),
                    ids[source[first[own]]].astype("<i8"),
                    places[first[own]].astype("<u4"),
                )
                rows.append((_CLAIM, bucket, chunk, b"".join(p.tobytes() for p in parts)))
        return pa.Table.from_batches([_rows(rows)])

    return found


def _matches(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """For every list which names other chunks hold too, as bits."""

    def found(table: pa.Table) -> pa.Table:
        chunks, bucket, source, index, _, shared, _ = _joined(table, STRING_BYTES, buckets, False)
        rows = []
        order = np.lexsort((index, source))
        source, shared = source[order], shared[order]
        ends = np.searchsorted(source, np.arange(len(chunks) + 1))
        for i, chunk in enumerate(chunks):
            bits = shared[ends[i] : ends[i + 1]]
            if bits.any():
                rows.append((_STRING, bucket, chunk, np.packbits(bits).tobytes()))
        return pa.Table.from_batches([_rows(rows)])

    return found


def _bucket_starts(names: np.ndarray, buckets: int) -> np.ndarray:
    prefix = (names >> _U(64 - PREFIX_BITS)).astype(np.int64)
    return np.searchsorted(prefix, np.arange(buckets) * ((1 << PREFIX_BITS) // buckets))


# --- runs: half-open ranges, as arrays (n, 2) ----------------------------------------


def runs_of(marks: np.ndarray) -> np.ndarray:
    edges = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)], 1)


def marked(runs: np.ndarray, n: int) -> np.ndarray:
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, runs[:, 0], 1)
    np.add.at(change, runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


# --- steps on a chunk -----------------------------------------------------------------


def _first_places(names: np.ndarray, samples: np.ndarray, chunk_id: int, told: pa.Table, buckets: int):
    """Chunk and place of the first occurrence of every sample's name; chunk -1 if it is the only one."""
    distinct, first, inverse, count = np.unique(names, return_index=True, return_inverse=True, return_counts=True)
    owner = np.where(count > 1, chunk_id, -1)
    place = samples[first] if len(samples) else np.zeros(0, np.int64)
    starts = _bucket_starts(distinct, buckets)
    for _, bucket, payload in _messages(told):
        n = len(payload) // 16
        at = starts[bucket] + np.frombuffer(payload, "<u4", n).astype(np.int64)
        owner[at] = np.frombuffer(payload, "<i8", n, 4 * n)
        place[at] = np.frombuffer(payload, "<u4", n, 12 * n)
    return owner[inverse], place[inverse]


def _resolve(buckets: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def resolve(key: tuple, own: pa.Table, told: pa.Table) -> pa.Table:
        if not own.num_rows:
            return pa.Table.from_batches([_rows([])])
        chunk_id = key[0].as_py()
        chunk = Chunk.unpacked(own["payload"][0].as_py())
        size = len(chunk.data)
        samples, names = _tuple_names(chunk)
        owner, place = _first_places(names, samples, chunk_id, told, buckets)
        end = np.cumsum(chunk.length)
        doc = np.searchsorted(end, samples, side="right")
        shift = place - samples

        # starts with a repeated name at one of their shifts, whose string stays in its text
        held = owner >= 0
        reach = np.stack([np.maximum(samples - MODULUS + 1, end[doc] - chunk.length[doc]), samples + 1], 1)[held]
        reach[:, 1] = np.minimum(reach[:, 1], (end[doc] - LENGTH + 1)[held])
        candidate = marked(reach[reach[:, 0] < reach[:, 1]], size)

        # chains of samples whose first places lie at one shift, elsewhere
        away = held & ((owner != chunk_id) | (shift != 0))
        step = np.ones(len(samples), bool)
        step[1:] = (
            ~away[1:] | ~away[:-1] | (owner[1:] != owner[:-1]) | (shift[1:] != shift[:-1]) | (doc[1:] != doc[:-1])
        )
        head = np.flatnonzero(step)
        tail = np.append(head[1:], len(samples)) - 1
        spans = np.stack([samples[head], samples[tail] + TUPLE - LENGTH + 1], 1) if len(samples) else np.zeros((0, 2), int)
        proven = away[head] & (spans[:, 0] < spans[:, 1]) if len(samples) else np.zeros(0, bool)
        spans, head = spans[proven], head[proven]
        resolved = marked(spans, size)

        rows: list[tuple] = []
        moved = spans + shift[head][:, None] if len(head) else spans
        targets = owner[head] if len(head) else np.zeros(0, np.int64)
        for target in np.unique(targets):
            rows.append((_CLAIM, 0, int(target), moved[targets == target].astype("<i8").tobytes()))

        open_ = candidate & ~resolved
        used = np.zeros(len(chunk.keys), bool)
        for marks in (candidate, resolved):
            if size:
                used |= np.add.reduceat(np.append(marks, 0), end - chunk.length) * (chunk.length > 0) > 0
        for i in np.flatnonzero(~used):
            text = chunk.data[end[i] - chunk.length[i] : end[i]].tobytes()
            rows.append((_DOC, 0, chunk_id, _result(chunk.keys[i], len(text), 0, 0, hashlib.sha256(text).digest())))
        if used.any():
            starts = np.flatnonzero(open_)
            strings = np.unique(Hasher(chunk.data).at(starts, LENGTH))
            rows += [(_STRING, b, chunk_id, p) for b, p in pack(strings, STRING_BYTES, buckets)]
            runs = [runs_of(m).astype("<i8") for m in (open_, resolved)]
            head_ = np.array([len(r) for r in runs], "<i8").tobytes()
            body = chunk.part(np.flatnonzero(used)).packed()
            rows.append((_TEXTS, 0, chunk_id, b"".join([head_, *(r.tobytes() for r in runs), body])))
        return pa.Table.from_batches([_rows(rows)])

    return resolve


def _result(key: int | None, n_bytes: int, n_removed: int, n_spans: int, digest: bytes) -> bytes:
    return np.array([key or 0, key is None, n_bytes, n_removed, n_spans], "<i8").tobytes() + digest


def _finish(buckets: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def finish(key: tuple, own: pa.Table, told: pa.Table) -> pa.Table:
        if not own.num_rows:
            return pa.Table.from_batches([_rows([])])
        payload = own["payload"][0].as_py()
        n = np.frombuffer(payload, "<i8", 2)
        open_runs = np.frombuffer(payload, "<i8", 2 * n[0], 16).reshape(-1, 2)
        resolved = np.frombuffer(payload, "<i8", 2 * n[1], 16 + 16 * n[0]).reshape(-1, 2)
        chunk = Chunk.unpacked(payload[16 + 16 * int(n.sum()) :])
        size = int((chunk.begin + chunk.length).max())  # in places of the first chunk
        where = np.concatenate([np.arange(b, b + k) for b, k in zip(chunk.begin, chunk.length)])
        data = np.zeros(size, np.uint8)
        data[where] = chunk.data

        starts = np.flatnonzero(marked(open_runs, size)) if len(open_runs) else np.zeros(0, np.int64)
        distinct, inverse, count = np.unique(
            Hasher(data).at(starts, LENGTH), return_inverse=True, return_counts=True
        )
        shared = count > 1
        firsts = _bucket_starts(distinct, buckets)
        begun = [resolved]
        for kind, bucket, payload in _messages(told):
            if kind == _CLAIM:
                begun.append(np.frombuffer(payload, "<i8").reshape(-1, 2))
            else:
                bits = np.unpackbits(np.frombuffer(payload, np.uint8)).astype(bool)
                stop = firsts[bucket + 1] if bucket + 1 < buckets else len(distinct)
                shared[firsts[bucket] : stop] |= bits[: stop - firsts[bucket]]
        hits = starts[shared[inverse]] if len(starts) else starts
        begun.append(np.stack([hits, hits + 1], 1))
        runs = np.concatenate(begun)
        gone = marked(np.stack([runs[:, 0], runs[:, 1] + LENGTH - 1], 1), size)
        rows = []
        for k, b, length in zip(chunk.keys, chunk.begin, chunk.length):
            text, out = data[b : b + length], gone[b : b + length]
            digest = hashlib.sha256(text[~out].tobytes()).digest()
            rows.append((_DOC, 0, 0, _result(k, int(length), int(out.sum()), len(runs_of(out)), digest)))
        return pa.Table.from_batches([_rows(rows)])

    return finish


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        rows = []
        for payload in batch.column(0).to_pylist():
            key, gone, *counts = np.frombuffer(payload, "<i8", 5).tolist()
            rows.append((None if gone else key, *counts, payload[40:].hex()))
        columns = [pa.array([r[j] for r in rows], pa.int64() if j < 4 else pa.string()) for j in range(5)]
        yield pa.RecordBatch.from_arrays(columns, names)


def _bucket_count(spark: SparkSession, total: int) -> int:
    """A power of two: buckets of bounded size, several for every shuffle partition."""
    share = len(COVER) / MODULUS * (NAME_BYTES + 3)
    least = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), total * share / BUCKET_BYTES)
    return min(1 << PREFIX_BITS, 1 << int(least - 1).bit_length())


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    chunks = rows.mapInArrow(_chunks, "n_bytes long, payload binary")
    chunks, chunks_path = store(chunks.withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    buckets = _bucket_count(spark, chunks.agg(F.sum("n_bytes")).first()[0] or 1)

    lists = chunks.select("chunk", "payload").mapInArrow(_name_lists(buckets), _ROW)
    owners, owners_path = store(lists.groupBy("bucket").applyInArrow(_owners(buckets), _ROW), "first-places")
    by_chunk = chunks.select("chunk", "payload").groupBy("chunk")
    resolved = by_chunk.cogroup(owners.groupBy("chunk")).applyInArrow(_resolve(buckets), _ROW)
    steps = materialize(resolved, "resolved")
    for path in (chunks_path, owners_path):  # all that is left to do is in the steps
        drop_path(spark, path)

    matches = steps.where(F.col("kind") == _STRING).groupBy("bucket").applyInArrow(_matches(buckets), _ROW)
    told = steps.where(F.col("kind") == _CLAIM).union(materialize(matches, "matches"))
    # under new names, as both sides of the grouping come from one table
    texts = steps.where(F.col("kind") == _TEXTS).select(F.col("chunk").alias("own"), F.col("payload").alias("payload"))
    finished = texts.groupBy("own").cogroup(told.groupBy("chunk")).applyInArrow(_finish(buckets), _ROW)
    results = finished.union(steps.where(F.col("kind") == _DOC)).select("payload")
    schema = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return results.mapInArrow(_listed, schema).withColumnRenamed("key", key)
