"""Token counts: one dynamic programme over a trie of distinct units.

Texts are cut into units (see ``pieces``).  The distinct units of a slice of an Arrow batch
are put into a trie, level by level, and the forward scores - the best score of a prefix and its
number of ids - are computed once per node, so once per shared prefix.  Every node hands on
the pieces that are still open: where they began, and how far they have come in the trie of
pieces; a piece that ends relaxes its node.  Nodes where units end store their counts, and a
document's count is the sum over its units.  All nodes of a level are handled at once.

Units beyond ``TRIE_CHARS`` characters are counted one by one by the automaton instead.  A
batch's tables are dropped with it: memory is bounded by the batch, nothing is shuffled.

Null texts count as empty and have no tokens; repeated rows are counted one by one.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.encoding import Viterbi
from corpusloom.llm.pieces import Pieces, single_spaced, unit_names, unit_parts
from corpusloom.llm.worker import kept, sliced

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TRIE_CHARS = 64

#: Bytes of text whose units make one trie.
TRIE_BYTES = 16 << 20
_BITS = 21  # of a code point
_NONE = np.iinfo(np.int64).min // 2


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


class PieceTrie:
    """Transitions ``state, code point -> state`` of the trie of pieces, as sorted arrays."""

    def __init__(self, pieces: Pieces) -> None:
        states: dict[str, int] = {"": 0}
        steps: list[tuple[int, int]] = []
        for piece in pieces.scores:
            for n in range(1, len(piece) + 1):
                if piece[:n] not in states:
                    states[piece[:n]] = len(states)
                    steps.append(((states[piece[: n - 1]] << _BITS) | ord(piece[n - 1]), states[piece[:n]]))
        steps.sort()
        self.keys = np.array([k for k, _ in steps], np.int64)
        self.targets = np.array([t for _, t in steps], np.int64)
        self.scores = np.full(len(states), _NONE, np.int64)
        for piece, score in pieces.scores.items():
            self.scores[states[piece]] = score
        self.spelt = pieces.spelt

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Next states, -1 where no piece goes on."""
        key = (state << _BITS) | code
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.targets[at], -1)


def count_by_trie(units: list[str], pieces: PieceTrie) -> np.ndarray:
    """Number of ids of every distinct, non-empty unit."""
    order = sorted(range(len(units)), key=units.__getitem__)
    lengths = np.array([len(units[i]) for i in order], np.int64)
    codes = _codes("".join(units[i] for i in order))
    begin = np.cumsum(lengths) - lengths
    result = np.zeros(len(units), np.int64)
    order_ = np.array(order, np.int64)

    node = np.zeros(len(units), np.int64)  # of the level, for every unit
    best, count = np.zeros(1, np.int64), np.zeros(1, np.int64)
    first, open_ = np.zeros(1, np.int64), np.zeros(1, np.int64)  # open pieces of a node
    state, from_best, from_count = (np.zeros(0, np.int64) for _ in range(3))
    alive = np.arange(len(units))
    for depth in range(int(lengths.max(initial=0))):
        alive = alive[lengths[alive] > depth]
        key = (node[alive] << _BITS) | codes[begin[alive] + depth]
        new = np.concatenate([[True], key[1:] != key[:-1]])  # units are sorted, so nodes are too
        child = np.cumsum(new) - 1
        parent, code = key[new] >> _BITS, key[new] & ((1 << _BITS) - 1)

        # open pieces of the parent, and one that begins here
        n = open_[parent]
        owner = np.repeat(np.arange(len(parent)), n)
        source = np.repeat(first[parent] - (np.cumsum(n) - n), n) + np.arange(len(owner))
        owner = np.concatenate([owner, np.arange(len(parent))])
        s = np.concatenate([state[source], np.zeros(len(parent), np.int64)])
        b = np.concatenate([from_best[source], best[parent]])
        c = np.concatenate([from_count[source], count[parent]])
        s = pieces.step(s, code[owner])
        on = s >= 0
        owner, s, b, c = owner[on], s[on], b[on], c[on]

        # the node's best: a spelt character, or a piece that ends here
        spelt = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        node_best, node_count = best[parent] + pieces.spelt, count[parent] + spelt
        ends = pieces.scores[s] > _NONE
        score = b[ends] + pieces.scores[s[ends]]
        top = node_best.copy()
        np.maximum.at(top, owner[ends], score)
        fewest = np.where(node_best == top, node_count, np.iinfo(np.int64).max)
        equal = score == top[owner[ends]]
        np.minimum.at(fewest, owner[ends][equal], c[ends][equal] + 1)
        best, count = top, fewest

        by_owner = np.argsort(owner, kind="stable")
        state, from_best, from_count = s[by_owner], b[by_owner], c[by_owner]
        open_ = np.bincount(owner, minlength=len(parent))
        first = np.cumsum(open_) - open_
        node[alive] = child
        done = alive[lengths[alive] == depth + 1]
        result[order_[done]] = count[node[done]]
    return result


class Counter:
    def __init__(self, path: str) -> None:
        pieces = Pieces(path)
        self.trie, self.viterbi = PieceTrie(pieces), Viterbi(pieces)

    def units(self, names: list[str]) -> np.ndarray:
        """Number of ids of every named unit."""
        owners: list[int] = []
        parts: list[str] = []
        totals = np.zeros(len(names), np.int64)
        for i, name in enumerate(names):
            head, rest = unit_parts(name)
            totals[i] = len(rest)  # a byte for every line feed
            for part in (head, *rest):
                if len(part) > TRIE_CHARS:
                    totals[i] += self.viterbi.count(part)
                elif part:
                    owners.append(i)
                    parts.append(part)
        distinct = {p: k for k, p in enumerate(dict.fromkeys(parts))}
        counts = count_by_trie(list(distinct), self.trie)
        if parts:
            np.add.at(totals, owners, counts[[distinct[p] for p in parts]])
        return totals

    def documents(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of every text."""
        texts = pc.fill_null(texts, "")
        plain = single_spaced(texts)
        result = np.zeros(len(texts), np.int64)
        split = pc.split_pattern(texts.filter(pa.array(plain)), " ")
        words = split.flatten().dictionary_encode()
        counts = self.units(words.dictionary.to_pylist())
        sums = np.concatenate([[0], np.cumsum(counts[words.indices.to_numpy()])])
        ends = split.offsets.to_numpy() - split.offsets[0].as_py()
        result[plain] = sums[ends[1:]] - sums[ends[:-1]]
        for i in np.flatnonzero(~plain):
            names = unit_names(texts[i].as_py())
            distinct = list(dict.fromkeys(names))
            by_name = dict(zip(distinct, self.units(distinct).tolist()))
            result[i] = sum(by_name[n] for n in names)
        return result


def _counted(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept(f"piece counts of {path}", lambda: Counter(path))
        for batch in sliced(batches, 1, TRIE_BYTES):
            counts = pa.array(counter.documents(batch.column(1).cast(pa.large_string())))
            yield pa.RecordBatch.from_arrays([batch.column(0), counts], ["k0", "n_tokens"])

    return count


def count_tokens(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens`` of every row."""
    rows = docs.select(F.col(key).alias("k0"), F.col(text).alias("text"))
    kind = rows.schema["k0"].dataType.simpleString()
    counted = rows.mapInArrow(_counted(vocabulary), f"k0 {kind}, n_tokens long")
    return counted.select(F.col("k0").alias(key), "n_tokens")
