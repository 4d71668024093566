"""SentencePiece encoding and decoding: Viterbi over the matches of one automaton.

An Aho-Corasick automaton of all pieces reads a unit once.  At every position its output
links name all pieces that end there, longest first, and each relaxes the best score of the
position behind it; characters that nothing covers are spelt in bytes.  Decoding joins the
pieces' bytes, so every text comes back exactly.

Units repeat, so a worker keeps the ids of those it has met, up to a fixed number; memory
does not grow with the input.  Rows are independent: no shuffle, and a lost executor costs
its running tasks.

Null texts count as empty, empty texts have no ids, repeated rows are encoded one by one.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.pieces import LITERAL, SPACE, Pieces, single_spaced, unit_names, unit_parts
from corpusloom.llm.worker import gathered, kept, sliced

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CACHED_UNITS = 1 << 19
CACHED_CHARS = 64

_UNREACHED = -(1 << 62)


class Viterbi:
    """Best segmentation of strings; ``segment`` gives ids, ``count`` their number."""

    def __init__(self, pieces: Pieces) -> None:
        import ahocorasick

        self.pieces = pieces
        self.automaton = ahocorasick.Automaton()
        for piece, i in pieces.ids.items():
            self.automaton.add_word(piece, (len(piece), pieces.scores[piece], i))
        self.automaton.make_automaton()
        self.singles = {piece for piece in pieces.ids if len(piece) == 1}

    def _best(self, unit: str) -> tuple[list[int], list[int]]:
        """For every position the length of the last piece, and its id (-1: spelt)."""
        if not self.singles.issuperset(unit):
            return self._best_spelt(unit)
        # every character is a piece, at more than the score of a spelt one, so none is spelt
        n = len(unit)
        score, ids, last, token = [_UNREACHED] * (n + 1), [0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        score[0] = 0
        for end, (length, gain, piece) in self.automaton.iter(unit):
            stop = end + 1
            start = stop - length
            s, own = score[start] + gain, score[stop]
            if s > own or (s == own and ids[start] + 1 < ids[stop]):
                score[stop], ids[stop], last[stop], token[stop] = s, ids[start] + 1, length, piece
        self._ids = ids
        return last, token

    def _best_spelt(self, unit: str) -> tuple[list[int], list[int]]:
        n = len(unit)
        spelt, lowest = self.pieces.spelt, None
        score: list[int | None] = [lowest] * (n + 1)
        ids, last, token = [0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        score[0] = 0
        at = 0

        def spell(a: int) -> None:
            s, k = score[a] + spelt, ids[a] + utf8_length(unit[a])
            own = score[a + 1]
            if own is None or s > own or (s == own and k < ids[a + 1]):
                score[a + 1], ids[a + 1], last[a + 1], token[a + 1] = s, k, 1, -1

        for end, (length, gain, piece) in self.automaton.iter(unit):
            while at < end:  # positions before this one are settled now
                spell(at)
                at += 1
            start, stop = end + 1 - length, end + 1
            s, k, own = score[start] + gain, ids[start] + 1, score[stop]
            if own is None or s > own or (s == own and k < ids[stop]):
                score[stop], ids[stop], last[stop], token[stop] = s, k, length, piece
        while at < n:
            spell(at)
            at += 1
        self._ids = ids
        return last, token

    def count(self, unit: str) -> int:
        self._best(unit)
        return self._ids[-1]

    def segment(self, unit: str) -> list[int]:
        last, token = self._best(unit)
        found: list[list[int]] = []
        at = len(unit)
        while at:
            if token[at] >= 0:
                found.append([token[at]])
            else:
                char = unit[at - 1].replace(LITERAL, SPACE)
                found.append([self.pieces.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")])
            at -= last[at]
        return list(chain.from_iterable(reversed(found)))


def utf8_length(char: str) -> int:
    code = ord(char)
    return 1 if code < 0x80 else 2 if code < 0x800 else 3 if code < 0x10000 else 4


class PieceCodec:
    """Texts to ids and back."""

    def __init__(self, path: str) -> None:
        self.pieces = Pieces(path)
        self.viterbi = Viterbi(self.pieces)
        self.feed = self.pieces.byte_ids[10]
        self.known: dict[str, bytes] = {}

    def _unit(self, name: str) -> bytes:
        first, rest = unit_parts(name)
        ids = self.viterbi.segment(first)
        for part in rest:
            ids.append(self.feed)
            ids.extend(self.viterbi.segment(part))
        return array("i", ids).tobytes()

    def _lookup(self, names: list[str]) -> list[bytes]:
        """Packed ids of distinct units."""
        known = self.known
        own = {n: self._unit(n) for n in names if n not in known}
        packed = [own[n] if n in own else known[n] for n in names]
        if len(known) + len(own) > CACHED_UNITS:
            known.clear()
        known.update((n, ids) for n, ids in own.items() if len(n) <= CACHED_CHARS)
        return packed

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text."""
        names = unit_names(text or "")
        distinct = list(dict.fromkeys(names))
        by_name = dict(zip(distinct, self._lookup(distinct)))
        return np.frombuffer(b"".join([by_name[n] for n in names]), np.int32)

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of every text; units of texts with single spaces are looked up together."""
        plain = single_spaced(texts)
        split = pc.split_pattern(texts.filter(pa.array(plain)), " ")
        words = split.flatten().dictionary_encode()
        packed = self._lookup(words.dictionary.to_pylist())
        length = np.array([len(p) // 4 for p in packed], np.int64)
        flat = np.frombuffer(b"".join(packed), np.int32)
        ids, n = gathered(flat, np.cumsum(length) - length, length, words.indices.to_numpy())
        before = np.concatenate([[0], np.cumsum(n)])
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        found = iter(np.split(ids, before[offsets[1:-1]]))
        return [next(found) if p else self.encode(texts[i].as_py()) for i, p in enumerate(plain)]

    def decode(self, ids: np.ndarray) -> str:
        data = self.pieces.data
        return b"".join([data[i] for i in ids.tolist()])[1:].decode("utf-8", "surrogatepass")

    def comes_back(self, texts: pa.Array, ids: list[np.ndarray]) -> list[bool]:
        """Whether decoding gives every text back, byte by byte."""
        length = np.array([len(d) for d in self.pieces.data], np.int64)
        flat = np.frombuffer(b"".join(self.pieces.data), np.uint8)
        joined = np.concatenate([np.zeros(0, np.int32), *ids])
        decoded, n = gathered(flat, np.cumsum(length) - length, length, joined)
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum([len(x) for x in ids], dtype=np.int64)] if ids else []
        same, begin = [], 0
        for text, end in zip(texts, ends):
            own = text.as_buffer()
            part = decoded[begin + 1 : end]  # behind the space in front of every text
            same.append(bool(len(part) == own.size and np.array_equal(part, np.frombuffer(own, np.uint8))))
            begin = end
        return same


def _encoded(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(f"pieces of {path}", lambda: PieceCodec(path))
        for batch in sliced(batches, -1):
            texts = pc.fill_null(batch.column(batch.num_columns - 1).cast(pa.large_string()), "")
            ids = codec.encode_all(texts)
            ends = np.cumsum([0] + [len(x) for x in ids], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
            same = codec.comes_back(texts, ids)
            names = [*batch.schema.names[:-1], "ids", "lossless"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists, pa.array(same)], names)

    return encode


def encode_documents(docs: DataFrame, vocabulary: str, *keep: str, text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``ids``, ``n_tokens`` and whether decoding gave the text back."""
    rows = docs.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), F.col(text).alias("t"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    found = rows.mapInArrow(_encoded(vocabulary), f"{schema}, ids array<int>, lossless boolean")
    return found.select(
        *(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)),
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        "lossless",
    )


def _decoded(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(f"pieces of {path}", lambda: PieceCodec(path))
        for batch in batches:
            texts = [codec.decode(np.array(ids.as_py() or [], np.int32)) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["k0", "text"])

    return decode


def decode_documents(encoded: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, text`` of encoded documents."""
    rows = encoded.select(F.col(key).alias("k0"), F.col(ids).cast("array<int>").alias("ids"))
    kind = rows.schema["k0"].dataType.simpleString()
    return rows.mapInArrow(_decoded(vocabulary), f"k0 {kind}, text string").select(F.col("k0").alias(key), "text")
