"""The trie of conversation prefixes, built in sorted shards below a skeleton of splitters.

A node is a distinct sequence of first turns (role, text); a conversation is the path of the
digests of its turns, 16 bytes of SHA-256 each, so that a prefix of turns is a prefix of bytes.

* Texts end where they are read: a turn goes on as its digest and number of words.  One
  shuffle by groups of 20 conversations brings a group's conversations and the one that lends
  its first turns together.
* Conversations of one path are gathered before anything else, in chunks of ids that share all
  but the last 12 bits, with partial aggregation: a path that a third of all conversations
  take is one row per chunk.
* Splitters: a sample of paths, chosen by hash, gives the bounds of the shards, each cut to the
  shortest prefix that parts its neighbours in the sample.  A node in more than one shard is a
  prefix of a splitter, so the trie of the splitters - the skeleton, of at most ``DEPTH`` nodes
  for each shard - is all that shards need to know of each other; it is sent to all tasks.
* A shard is sorted by path.  One pass with a stack of open nodes finishes all nodes but those
  of the skeleton, of which it gives partial counts; these are added up by one small
  aggregation and then folded from the leaves to the root.
* Digests of the ids that end at a node are fed chunk by chunk, in order, with one node's state
  held.

The sample sets the sizes of the shards only, never a result.  The turns of one conversation
(digests, not texts) are held by one task.

Null roles and texts are empty, null turns come first, and rows of one turn are ordered by role,
then by the digest of the turn; repeated rows are turns of their own.  Rows without a
conversation id are left out.  An empty table has no nodes, not even a root.  Other columns may
have any names.
"""

from __future__ import annotations

import hashlib
import sys
from bisect import bisect_right
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import WORD, materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Conversations of a group, whose first turns come from the one of the lowest id, and the
#: number below which those turns are.
GROUP, LENT = 20, 4

#: Bytes of a turn's digest.
STEP = 16

#: Conversation ids that share all but these last bits are one chunk of a path.
CHUNK_BITS = 12

#: Sampled paths for each shard, and turns of a path that the sample holds.
SAMPLED, DEPTH = 16, 256

_CHUNK = "path binary, high long, words array<int>, n long, low long, ids string"
_NODE = (
    "skeleton int, parent int, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, words long"
)
_CHUNKS = [c.split()[0] for c in _CHUNK.split(", ")]
_COLUMNS = [c.split()[0] for c in _NODE.split(", ")]
_COUNTS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


def conversation_paths(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, path, words`` of every conversation, first turns lent within its group."""
    said = F.coalesce(F.col(text), F.lit(""))
    by = F.coalesce(F.col(role), F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(by), F.lit(":"), by, said), 256), 1, 2 * STEP)
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"), by.alias("role"), digest.alias("step"),
            F.regexp_count(said, F.lit(WORD)).alias("words"),
        ).alias("turn"),
    )
    rows = rows.withColumn("group", F.col("conv_id") - F.col("conv_id") % GROUP).repartition("group")
    own = rows.groupBy("group", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("own"))
    lender = own.where(F.col("conv_id") == F.col("group")).select("group", F.slice("own", 1, LENT - 1).alias("lent"))
    n = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENT).cast("int")
    kept = F.slice("own", n + 1, F.size("own"))
    lent = F.when(F.col("lent").isNull(), F.slice("own", 1, 0)).otherwise(F.slice("lent", 1, n))
    rebuilt = own.join(lender, "group", "left").select("conv_id", F.concat(lent, kept).alias("turns"))
    path = F.unhex(F.array_join(F.col("turns.step"), "")).alias("path")
    return rebuilt.select("conv_id", path, F.col("turns.words").alias("words"))


def common_steps(a: bytes, b: bytes) -> int:
    """Turns that two paths begin with alike."""
    low, high = 0, min(len(a), len(b)) // STEP
    while low < high:  # prefixes of a common prefix are common
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[: middle * STEP] == b[: middle * STEP] else (low, middle - 1)
    return low


def splitters(sample: list[bytes], n_shards: int) -> list[bytes]:
    """Bounds that part the sorted distinct paths of a sample into about equal shards."""
    between = [right[: (common_steps(left, right) + 1) * STEP] for left, right in pairwise(sample)]
    step = max(len(sample) / n_shards, 1)
    return sorted({between[int(i * step) - 1] for i in range(1, n_shards) if 0 < int(i * step) <= len(between)})


class Skeleton:
    """The trie of the splitters: node numbers by parent and step, the root being 0."""

    def __init__(self, bounds: list[bytes]) -> None:
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth = [-1], [0]
        for bound in bounds:
            node = 0
            for at in range(0, len(bound), STEP):
                key = (node, bound[at : at + STEP])
                if key not in self.child:
                    self.child[key] = len(self.parent)
                    self.parent.append(node)
                    self.depth.append(self.depth[node] + 1)
                node = self.child[key]


class Node:
    """An open node of a shard; ``number`` is its place in the skeleton, or None."""

    __slots__ = ("number", "words", "n", "low", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, number: int | None, words: int) -> None:
        self.number, self.words = number, words
        self.n = self.children = self.leaves = self.saved = 0
        self.low = self.ends = None
        self.waiting: list[tuple] = []

    def add(self, n: int, low: int) -> None:
        self.n += n
        self.low = low if self.low is None else min(self.low, low)


def _hex(ends) -> str:
    return (ends or hashlib.sha256()).hexdigest()


class Shard:
    """Chunks in the order of their paths to finished nodes and partial skeleton nodes."""

    def __init__(self, skeleton: Skeleton) -> None:
        self.skeleton, self.path = skeleton, b""
        self.open = [Node(0, 0)]
        self.rows: list[tuple] = []

    def close(self, depth: int) -> None:
        while len(self.open) > depth:
            node = self.open.pop()
            level = len(self.open)
            if node.number is not None:
                ends = node.ends and _hex(node.ends)
                self.rows.append(
                    (node.number, None, node.low, level, None, node.n, node.children, node.leaves, node.saved, ends, node.words)
                )
                continue
            above = self.open[-1]
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.n - 1) * node.words
            self.rows += [(None, None, *row[:2], node.low, *row[2:], None) for row in node.waiting]
            row = (node.low, level, node.n, node.children, leaves, saved, _hex(node.ends))
            if above.number is None:
                above.waiting.append(row)  # until the lowest id of the node above is known
            else:
                self.rows.append((None, above.number, *row[:2], None, *row[2:], None))
            above.add(node.n, node.low)
            above.children += 1
            above.leaves += leaves
            above.saved += saved

    def add(self, path: bytes, words: list[int], n: int, low: int, ids: str) -> None:
        same = common_steps(self.path, path)
        self.close(same + 1)
        for depth in range(same, len(path) // STEP):
            number = self.open[-1].number
            if number is not None:
                number = self.skeleton.child.get((number, path[depth * STEP : (depth + 1) * STEP]))
            self.open.append(Node(number, words[depth]))
        self.path = path
        node = self.open[-1]
        node.add(n, low)
        if node.ends is None:
            node.ends = hashlib.sha256(ids.encode())
        else:
            node.ends.update(b"," + ids.encode())


def _shards(skeleton: Skeleton):
    kinds = [pa.int32()] * 2 + [pa.int64()] * 7 + [pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished():
            rows, shard.rows = shard.rows, []
            arrays = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(arrays, _COLUMNS)

        shard, any_rows = Shard(skeleton), False
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                any_rows = True
                shard.add(*row)
                if len(shard.rows) >= 8192:
                    yield finished()
        if any_rows:
            shard.close(0)
            yield finished()

    return run


def _numbered(bounds: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = [bisect_right(bounds, path) for path in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], [*batch.schema.names, "shard"])

    return run


def folded(skeleton: Skeleton, partial: dict[int, tuple]) -> list[tuple]:
    """Whole skeleton nodes, as rows of ``_NODE``, from the sums over all shards."""
    size = len(skeleton.parent)
    n, children, leaves, saved = ([partial[i][k] if i in partial else 0 for i in range(size)] for k in range(4))
    low = [partial[i][4] if i in partial else None for i in range(size)]
    for i in reversed(range(size)):  # a node has a higher number than the one above it
        if not n[i]:
            continue
        leaves[i] = leaves[i] if children[i] else 1
        saved[i] += (n[i] - 1) * partial[i][6]
        above = skeleton.parent[i]
        if above >= 0:
            n[above] += n[i]
            children[above] += 1
            leaves[above] += leaves[i]
            saved[above] += saved[i]
            low[above] = low[i] if low[above] is None else min(low[above], low[i])
    return [
        (i, None, low[i], skeleton.depth[i], low[skeleton.parent[i]] if i else None, n[i], children[i], leaves[i], saved[i],
         partial[i][5] or _hex(None), None)
        for i in range(size) if n[i]
    ]


def prefix_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node; the ids of conversations must be integers."""
    spark = turns.sparkSession
    paths = conversation_paths(turns, conv, turn, role, text)
    chunks = paths.groupBy("path", F.shiftright("conv_id", CHUNK_BITS).alias("high")).agg(
        F.any_value("words").alias("words"),
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("low"),
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
    )
    chunks = materialize(chunks, "chunks")
    n_shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    drawn = chunks.select(F.substring("path", 1, DEPTH * STEP).alias("path"), F.xxhash64("path", "high").alias("draw"))
    drawn = drawn.orderBy("draw").limit(SAMPLED * n_shards).select("path").distinct().collect()
    bounds = splitters(sorted(bytes(r["path"]) for r in drawn), n_shards)
    skeleton = Skeleton(bounds)
    numbered = chunks.select(_CHUNKS).mapInArrow(_numbered(bounds), f"{_CHUNK}, shard int")
    sorted_shards = numbered.repartitionById(n_shards, F.col("shard")).sortWithinPartitions("path", "high")
    nodes = materialize(sorted_shards.select("path", "words", "n", "low", "ids").mapInArrow(_shards(skeleton), _NODE), "nodes")
    partial = nodes.where(F.col("skeleton").isNotNull()).groupBy("skeleton").agg(
        *(F.sum(c).alias(c) for c in _COUNTS),
        F.min("conv_id").alias("conv_id"),
        F.max("ends_sha256").alias("ends_sha256"),
        F.max("words").alias("words"),
    )
    whole = spark.createDataFrame(folded(skeleton, {r[0]: tuple(r[1:]) for r in partial.collect()}), _NODE)
    above = F.broadcast(whole.select(F.col("skeleton").alias("parent"), F.col("conv_id").alias("low")))
    local = nodes.where(F.col("skeleton").isNull()).join(above, "parent", "left")
    local = local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "low"))
    shown = _COLUMNS[2:-1]
    return local.select(shown).unionByName(whole.select(shown))
