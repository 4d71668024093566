"""The best documents of every item, scored once for all documents of one bag of words.

Only the terms of the items decide a score, so a document is its term counts restricted to
them, plus the length norm ``m``: many documents, copies above all, are the same bag.

* Items are taken in blocks of about ``BLOCK_BYTES`` of text, usually one; a block's
  vocabulary is what a worker holds.  Everything below is done for each block.
* Bags: one narrow pass over whole texts counts terms by numbers of the vocabulary.
* Classes: bags are grouped by hash, terms, counts and ``m`` - the hash finds candidates, the
  equal vectors verify them - with partial aggregation, so a group of copies leaves each
  task as one row.  Document frequencies are sums of class sizes.
* Scores: tasks multiply slices of class vectors by item weights, in tiles of bounded size.
  All numbers are integers below 2**53, so doubles are exact; an item that could pass
  that bound is multiplied in 64-bit integers.  A task keeps the ``best`` classes of an item
  by score and lowest member, which hold its best documents: whoever precedes a document
  by score and id brings a class no lower than its own.
* Members: the chosen classes are joined back to the bags, at most ``best`` members of each
  are kept by ascending id, and the last ranking is among those.

A null text or item has no terms.  A row is a document: rows of one id are ranked each by
itself, null ids after all others.  The distinct rows of one item id, null included, are one
item of all their terms.  Items without terms, or whose terms no document holds, have no rows;
empty tables give none.  Very long texts are counted whole.  Other columns of either table
may have any names.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import BROADCAST_BYTES, materialize
from corpusloom.llm.worker import sliced
from corpusloom.operators.numbering import dense_index

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Terms are runs of ASCII digits and letters and of anything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Text of the items that are ranked in one pass over the documents.
BLOCK_BYTES = 4 << 20

#: Rows and columns of a tile of class vectors, items of a tile of weights, cells of the latter.
ROWS, COLUMNS, ITEMS, CELLS = 512, 8192, 256, 4 << 20

#: Sums below this are exact in doubles.
EXACT = 1 << 53

#: No term's count in a document, whatever it is, weighs more.
FULL = 1_000_000

_BAG = "doc_id long, n long, terms array<int>, tfs array<int>"
_TOP = "item int, score long, class_id long, first long"
_LAST = (1 << 63) - 1  # stands for a null id


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), 0)


def _separators() -> bytes:
    """A byte table: terms' bytes in lower case, all others a space."""
    return bytes(c if c > 127 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())


def _bags(vocabulary: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: i for i, term in enumerate(vocabulary)}.get
        table, size = _separators(), len(vocabulary)
        for batch in sliced(batches, 1):
            texts = pc.fill_null(batch.column(1).cast(pa.binary()), b"").to_pylist()
            found, lengths = [], np.zeros(len(texts), np.int64)
            for row, text in enumerate(texts):
                tokens = text.translate(table).split()
                lengths[row] = len(tokens)
                ids = np.fromiter(map(number, tokens, repeat(-1)), np.int64, len(tokens))
                found.append(ids[ids >= 0] + row * size)
            cells, counts = np.unique(np.concatenate(found), return_counts=True)
            ends = np.searchsorted(cells, np.arange(len(texts) + 1) * size).astype(np.int32)
            terms = pa.array((cells % max(size, 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lengths),
                    pa.ListArray.from_arrays(ends, terms),
                    pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int32))),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return run


class Weights:
    """The item weights of a block, handed out in tiles ``items, columns, lookup, matrix``."""

    def __init__(self, item: np.ndarray, term: np.ndarray, weight: np.ndarray, n_items: int, n_terms: int) -> None:
        order = np.lexsort((term, item))
        self.item, self.term, self.weight = item[order], term[order], weight[order]
        self.n_items, self.n_terms = n_items, n_terms
        ends = np.searchsorted(self.item, np.arange(n_items + 1))
        self.cuts, first = [], 0
        while first < n_items:
            last = first + 1
            while last < n_items and last - first < ITEMS and (last + 1 - first) * (ends[last + 1] - ends[first]) <= CELLS:
                last += 1
            self.cuts.append((first, last, ends[first], ends[last]))
            first = last
        self.only = self._tile(*self.cuts[0]) if len(self.cuts) == 1 else None

    def _tile(self, first: int, last: int, low: int, high: int):
        columns, place = np.unique(self.term[low:high], return_inverse=True)
        lookup = np.full(self.n_terms, -1, np.int64)
        lookup[columns] = np.arange(len(columns))
        item, weight = self.item[low:high] - first, self.weight[low:high]
        sums = np.bincount(item, weight, last - first)
        kind = np.float64 if sums.max(initial=0) * FULL < EXACT else np.int64
        matrix = np.zeros((len(columns), last - first), kind)
        matrix[place, item] = weight
        return first, lookup, matrix

    def tiles(self):
        yield from [self.only] if self.only else (self._tile(*cut) for cut in self.cuts)


class Best:
    """The best rows of each item so far, by score and then by the lowest document."""

    def __init__(self, n_items: int, best: int) -> None:
        self.least, self.best = np.ones(n_items, np.int64), best
        self.rows = [np.empty((4, 0), np.int64)]

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray, lowest: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least[first : first + scores.shape[1]])
        if len(row):
            self.rows.append(np.stack([item + first, scores[row, item], ids[row], lowest[row]]))
            if sum(r.shape[1] for r in self.rows) > 4 * self.best * len(self.least) + ROWS:
                self.pruned()

    def pruned(self) -> np.ndarray:
        all_rows = np.concatenate(self.rows, axis=1)
        all_rows = all_rows[:, np.lexsort((all_rows[3], -all_rows[1], all_rows[0]))]
        start = np.searchsorted(all_rows[0], all_rows[0])
        rank = np.arange(all_rows.shape[1]) - start
        last = all_rows[:, rank == self.best - 1]
        self.least[last[0]] = last[1]
        self.rows = [all_rows[:, rank < self.best]]
        return self.rows[0]


def _scores(weights: Weights, best: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = Best(weights.n_items, best)
        for whole in batches:
            for begin in range(0, whole.num_rows, ROWS):
                batch = whole.slice(begin, ROWS)
                ids, lowest, norm = (batch.column(k).to_numpy() for k in range(3))
                counts = pc.list_value_length(batch.column(3)).to_numpy()
                row = np.repeat(np.arange(batch.num_rows), counts)
                term = batch.column(3).flatten().to_numpy()
                tf = batch.column(4).flatten().to_numpy().astype(np.int64)
                value = 1_000_000_000 * tf // (1000 * tf + 12 * norm[row])
                for first, lookup, matrix in weights.tiles():
                    column = lookup[term]
                    sums = np.zeros((batch.num_rows, matrix.shape[1]), matrix.dtype)
                    for left in range(0, len(matrix), COLUMNS):
                        part = matrix[left : left + COLUMNS]
                        here = (column >= left) & (column < left + len(part))
                        tile = np.zeros((batch.num_rows, len(part)), matrix.dtype)
                        tile[row[here], column[here] - left] = value[here]
                        sums += tile @ part
                    top.add(first, sums.astype(np.int64), ids, lowest)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(top.pruned(), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
            ["item", "score", "class_id", "first"],
        )

    return run


def _first(rows: DataFrame, by: list[str], *order: Column, best: int, name: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn(name, rank).where(F.col(name) <= best)


def _ranked_block(docs: DataFrame, uses: DataFrame, n_items: int, totals, best: int):
    """Rankings of one block of items, whose rows are ``item, term, uses``; and N and L."""
    words = {}
    block = [(r["item"], words.setdefault(r["term"].encode(), len(words)), r["uses"]) for r in uses.collect()]
    item, term, times = (np.array(c, np.int64) for c in zip(*block))
    bags = materialize(docs.mapInArrow(_bags(list(words)), _BAG), "bags")
    n_docs, n_terms = totals or bags.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    norm = F.expr(f"75 + (25 * n * {n_docs}L) div {n_terms}L") if n_terms else F.lit(75)
    held = bags.where(F.size("terms") > 0).withColumn("m", norm.cast("long"))
    held = held.withColumn("hash", F.xxhash64("terms", "tfs", "m"))
    vector = ["hash", "terms", "tfs", "m"]
    classes = held.groupBy(vector).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n_docs"))
    classes = materialize(classes.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    counted = classes.select(F.explode("terms").alias("term"), "n_docs").groupBy("term").agg(F.sum("n_docs"))
    weight = np.zeros(len(words), np.int64)
    for number, df in counted.collect():  # one row per term of the block
        weight[number] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    weights = Weights(item, term, weight[term] * times, n_items, len(words))
    first = F.coalesce("first", F.lit(_LAST)).alias("first")
    scored = classes.select("class_id", first, "m", "terms", "tfs").mapInArrow(_scores(weights, best), _TOP)
    order = F.desc("score"), F.asc("first")
    top = materialize(_first(scored, ["item"], *order, best=best, name="place"), "best").select("item", "score", "class_id")
    chosen = classes.join(top.select("class_id").distinct(), "class_id", "left_semi").select("class_id", *vector)
    chosen = materialize(chosen, "chosen")
    size = chosen.agg(F.sum(F.size("terms") * 8 + 64)).first()[0] or 0
    members = held.join(F.broadcast(chosen) if size <= BROADCAST_BYTES else chosen, vector).select("class_id", "doc_id")
    doc = F.asc_nulls_last("doc_id")
    members = _first(members, ["class_id"], doc, best=best, name="place").drop("place")
    ranked = _first(members.join(top, "class_id"), ["item"], F.desc("score"), doc, best=best, name="rank")
    return ranked.select("item", "rank", "doc_id", "score"), (n_docs, n_terms)


def ranked_documents(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", best: int = 20,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents of each item, scores above 0.

    ``key`` must be an integer.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = items.select(F.col(item).alias("item_id"), F.col(item_text).alias("text")).distinct()
    uses = rows.select("item_id", F.explode(terms_of(F.col("text"))).alias("term"))
    uses = materialize(uses.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("uses")), "item-terms")
    names = materialize(dense_index(uses.select("item_id").distinct(), F.col("item_id"), name="number"), "items")
    size = uses.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    n_items, n_blocks = names.count(), -(-size // BLOCK_BYTES)
    uses = uses.join(names, uses["item_id"].eqNullSafe(names["item_id"])).select("number", "term", "uses")
    totals, parts = None, []
    for block in range(n_blocks):  # items block, block + n_blocks, ... are numbered 0, 1, ... here
        own = uses.where(F.col("number") % n_blocks == block)
        own = own.select((F.col("number") / n_blocks).cast("long").alias("item"), "term", "uses")
        n_own = len(range(block, n_items, n_blocks))
        if n_own:
            ranked, totals = _ranked_block(docs, own, n_own, totals, best)
            parts.append(ranked.withColumn("number", F.col("item") * n_blocks + block))
    if not parts:
        empty = names.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"))
        return empty.withColumn("score", F.col("doc_id")).limit(0)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.join(names, "number").select("item_id", "rank", "doc_id", "score")
