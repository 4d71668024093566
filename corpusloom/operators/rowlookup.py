"""Looking up the words of a document inside its row, against a shared table.

For tables of checked size this replaces a join: no row is exploded, moved and
collected again.  Arrow looks up the words of a whole batch with one hash table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The functions below travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Largest table, in bytes, that every Python worker holds for row-wise lookups.
#: Arrow makes its hash table anew for every batch, so larger tables are left to the join.
LOOKUP_BYTES = 32 * 1024 * 1024

#: Words looked up at once, so that what a worker makes of a batch does not grow with the batch.
SLICE_WORDS = 1 << 18


def _rows(lists: pa.ListArray) -> np.ndarray:
    """Row number of every element of a list column."""
    return np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))


def _lists(rows: np.ndarray, n_rows: int, values: pa.Array) -> pa.ListArray:
    """List column of ``n_rows`` rows from elements in row order."""
    ends = np.cumsum(np.bincount(rows, minlength=n_rows))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values)


def _find(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Position of every word in ``known``, -1 where it is missing."""
    return pc.index_in(words, known.cast(words.type)).fill_null(-1).to_numpy()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of at most SLICE_WORDS words; a row of more is a slice."""
    for batch in batches:
        ends = np.cumsum(np.diff(batch.column("words").offsets.to_numpy()), dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            room = SLICE_WORDS + (ends[first - 1] if first else 0)
            last = max(first + 1, int(np.searchsorted(ends, room, side="right")))
            yield batch.slice(first, last - first)
            first = last


def _map_rows(df: DataFrame, change, columns: str) -> DataFrame:
    id_type = df.schema["id"].dataType.simpleString()
    return df.mapInArrow(change, f"id {id_type}, {columns}")


def number_words(counts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``id, words, counts`` of every document, with the words as dictionary ids, ascending.

    Words outside the dictionary drop out; all documents keep their row.
    """
    table = dictionary.select("word", "id").toArrow()
    shared = counts.sparkSession.sparkContext.broadcast(
        (table["word"].combine_chunks(), table["id"].to_numpy())
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers = shared.value
        for batch in _slices(batches):
            words, uses = batch.column("words"), batch.column("counts")
            at = _find(words.flatten(), known)
            hit = at >= 0
            rows = _rows(words)[hit]
            ids = numbers[at[hit]].astype(np.int32)
            order = np.lexsort((ids, rows))
            counted = uses.flatten().to_numpy()[hit][order]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    _lists(rows, len(words), pa.array(ids[order], pa.int32())),
                    _lists(rows, len(words), pa.array(counted, pa.int32())),
                ],
                ["id", "words", "counts"],
            )

    return _map_rows(counted_words(counts), number, "words array<int>, counts array<int>")


def lemmatize_words(counts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``id, words, counts`` with the words replaced by their lemmas.

    ``lexicon(surface, lemma, kept)``: words that are not ``kept`` drop out, words
    it does not hold stay.  Equal lemmas of a document are not yet added up.
    """
    table = lexicon.select("surface", "lemma", "kept").toArrow()
    shared = counts.sparkSession.sparkContext.broadcast(
        tuple(table[name].combine_chunks() for name in ("surface", "lemma", "kept"))
    )

    def lemmatize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surfaces, lemmas, kept = shared.value
        for batch in _slices(batches):
            words, uses = batch.column("words"), batch.column("counts")
            flat = words.flatten()
            at = pc.index_in(flat, surfaces.cast(flat.type))
            stay = pc.fill_null(pc.take(kept, at), True)
            lemma = pc.coalesce(pc.take(lemmas.cast(flat.type), at), flat)
            rows = _rows(words)[stay.to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    _lists(rows, len(words), lemma.filter(stay)),
                    _lists(rows, len(words), uses.flatten().filter(stay)),
                ],
                ["id", "words", "counts"],
            )

    return _map_rows(counts, lemmatize, "words array<string>, counts array<int>")


def counted_words(counts: DataFrame) -> DataFrame:
    """``id, words, counts`` of ``id, terms`` rows."""
    return counts.select(
        "id", F.col("terms.word").alias("words"), F.col("terms.cnt").alias("counts")
    )


def single_words(tokens: DataFrame) -> DataFrame:
    """``id, words, counts`` of ``id, tokens`` rows, every token counted once."""
    ones = F.transform("tokens", lambda _: F.lit(1))
    return tokens.select("id", F.col("tokens").alias("words"), ones.alias("counts"))
