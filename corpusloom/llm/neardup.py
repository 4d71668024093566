"""Near duplicates: BagMinHash bands find pairs, the multisets of shingles decide.

A text is the bag of its five-word shingles (lower case; fewer words make one shingle).  Two
texts are linked if the weighted Jaccard similarity of their bags is 0.8 or more, and a class
is what links connect.  Class ids are the lowest document id of the class.

Texts of equal bags are one node from the start, so copies cost a row each and no pair.  Nodes
that share a band stand in one bucket.  Buckets are not paired out:

1. every member is compared to a hub of its bucket;
2. members of small buckets that are not connected yet are compared in pairs;
3. in large buckets the members outside the largest component are compared to all others, in
   blocks of bounded size that hold signatures and bags.  A block joins what it finds alike and
   goes on with the rest, so it gives back at most one link less than it has members, however
   many pairs are alike; a pair is looked at in one of its buckets only.

A pair is compared by signatures first, which drops pairs far below the limit, and by the
bags themselves then.  35 bands of 6 registers miss a pair of similarity 0.8 once in 40,000
times, and the signatures drop one as rarely; nothing else loses a link.

Shuffled are buckets, pairs and, for nodes that share a bucket, signatures and bags.  Hot
buckets and hubs are joins that Spark can split.  Links and components stay distributed; the
driver only gets counts.  Every step is a stored table, so a lost executor costs its tasks.

Null texts and texts without words are classes of their own; rows of one id and other texts
belong to the class of each text; rows without an id take no part; empty tables give none.
Very long texts are compared whole.  Only the columns named as ``key`` and ``text`` are read,
so others may have any names.
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

from corpusloom.llm.bagminhash import band_hashes, mix, signatures
from corpusloom.llm.common import broadcast_if_small, materialize
from corpusloom.llm.worker import sliced

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 35, 6

#: Members of a bucket up to which it is paired out; members, and bytes of their bags, of a
#: block of a larger one.
SMALL_BUCKET = 16
BLOCK_ROWS, BLOCK_BYTES = 1024, 4 << 20

#: Signatures that agree in fewer registers are dropped: 0.8 less four standard deviations.
ESTIMATE = 0.69

#: Labels of a task, where there are few.
PART_ROWS = 200_000

#: Shingles whose points a worker makes at once, and bytes of text that it takes up at once.
GROUP_SHINGLES = 100_000
SLICE_BYTES = 2 << 20

_U = np.uint64
_HASH_BYTES = 6  # of a shingle, in stored bags


def _word_hash(word: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every shingle of the texts, in order."""
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    split = pc.split_pattern_regex(texts, "[\\x20\\x09-\\x0D]+")
    words = split.flatten().dictionary_encode()
    names = words.dictionary.to_pylist()
    hashes = np.array([_word_hash(w) for w in names], np.uint64)
    full = np.array([w != "" for w in names], bool)
    index = words.indices.to_numpy()
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    held = full[index] if len(index) else np.zeros(0, bool)
    owner, h = owner[held], hashes[index[held]] if len(index) else np.zeros(0, np.uint64)
    n = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(n)
    position = np.arange(len(owner)) - (ends - n)[owner]
    starts = np.flatnonzero((position == 0) | (position + SHINGLE <= n[owner]))
    value = np.zeros(len(starts), np.uint64)
    for k in range(SHINGLE):
        inside = starts + k < ends[owner[starts]]
        value = mix(value ^ np.where(inside, h[np.minimum(starts + k, max(0, len(h) - 1))], _U(k)))
    return owner[starts], value


def bags(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle and count of every distinct shingle of a text."""
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return owner[at], value[at], np.diff(np.append(at, len(owner)))


def _groups(owner: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about GROUP_SHINGLES shingles each."""
    sizes = np.bincount(owner, minlength=n)
    first = total = 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > GROUP_SHINGLES:
            yield first, i
            first, total = i, 0
        total += size
    if n:
        yield first, n


def _nodes(owner: np.ndarray, value: np.ndarray, n: int) -> list[bytes | None]:
    """16 bytes that name the bag of every text; None for a text without words."""
    sums = np.zeros((n, 2), np.uint64)
    np.add.at(sums[:, 0], owner, mix(value))
    np.add.at(sums[:, 1], owner, mix(value ^ _U(0x2545F4914F6CDD1D)))
    held = np.bincount(owner, minlength=n) > 0
    return [row.tobytes() if h else None for row, h in zip(sums, held)]


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, node, bands, sig``; the short signature keeps 16 bits of a register."""
    for batch in sliced(batches, 1, SLICE_BYTES):
        n = batch.num_rows
        owner, value = shingles(batch.column(1))
        nodes = _nodes(owner, value, n)
        element = bags(owner, value)
        found = np.zeros((n, BANDS * ROWS), np.uint64)
        for a, b in _groups(element[0], n):
            lo, hi = np.searchsorted(element[0], [a, b])
            found[a:b] = signatures(*(x[lo:hi] if i else x[lo:hi] - a for i, x in enumerate(element)), b - a, BANDS * ROWS)
        buckets = band_hashes(found, BANDS, ROWS).view(np.int64)
        short = found.astype(np.uint16)
        bands = pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS), pa.int32()), pa.array(buckets.ravel()))
        sig = pa.array([s.tobytes() for s in short], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(nodes, pa.binary()), bands, sig], ["key", "node", "bands", "sig"]
        )


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, bag``: sorted shingles, each as often as it occurs, a few bytes each; copies
    within a slice are left out."""
    for batch in sliced(batches, 0, SLICE_BYTES):
        n = batch.num_rows
        owner, value = shingles(batch.column(0))
        nodes = _nodes(owner, value, n)
        value = value >> _U(64 - 8 * _HASH_BYTES)
        order = np.lexsort((value, owner))
        ends = np.cumsum(np.bincount(owner, minlength=n))
        packed = value[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_HASH_BYTES]
        first = {node: i for i, node in reversed(list(enumerate(nodes))) if node is not None}
        rows = [(node, packed[(ends[i - 1] if i else 0) : ends[i]].tobytes()) for node, i in first.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[j] for r in rows], pa.binary()) for j in (0, 1)], ["node", "bag"]
        )


def _close_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (
            np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for k in (2, 3)
        )
        close = (a == b).mean(axis=1) >= ESTIMATE if batch.num_rows else np.zeros(0, bool)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(close))


def _unpacked(bag: bytes) -> np.ndarray:
    wide = np.zeros((len(bag) // _HASH_BYTES, 8), np.uint8)
    wide[:, :_HASH_BYTES] = np.frombuffer(bag, np.uint8).reshape(-1, _HASH_BYTES)
    return wide.view("<u8").ravel()


def overlap(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and the union of two sorted multisets."""
    if not len(a) or not len(b):
        return 0, len(a) + len(b)
    x, n = np.unique(a, return_counts=True)
    y, k = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], k[j]).sum())
    return both, len(a) + len(b) - both


def _overlaps(bag: tuple[np.ndarray, np.ndarray], others: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Sizes of the intersections of a multiset, as sorted values and counts, with others."""
    value, count = bag
    sizes = np.array([len(v) for v, _ in others])
    theirs, n = np.concatenate([v for v, _ in others]), np.concatenate([c for _, c in others])
    at = np.minimum(np.searchsorted(value, theirs), len(value) - 1)
    both = np.where(value[at] == theirs, np.minimum(count[at], n), 0)
    return np.add.reduceat(both, np.cumsum(sizes) - sizes)


def _links(table: pa.Table) -> pa.Table:
    """Links ``a, b`` of a block: members of ``side`` 0 with those of side 1, none twice connected.

    Members of side 0 are outside the bucket's largest component.  Of two such members, which
    meet twice, the lower one looks at the higher.
    """
    nodes = table["node"].to_pylist()
    names = {name: i for i, name in enumerate(sorted(set(table["comp"].to_pylist())))}
    label = np.array([names[c] for c in table["comp"].to_pylist()])
    band = table["band"][0].as_py()
    sigs = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint16).reshape(len(nodes), -1)
    bags = [np.unique(_unpacked(b), return_counts=True) for b in table["bag"].to_pylist()]
    size = np.array([int(n.sum()) for _, n in bags])
    side, outside = table["side"].to_numpy(), table["outside"].to_numpy(zero_copy_only=False)
    order = {name: i for i, name in enumerate(sorted(set(nodes)))}
    rank = np.array([order[name] for name in nodes])
    right = np.flatnonzero(side == 1)
    found: list[tuple[bytes, bytes]] = []
    for x in np.flatnonzero(side == 0).tolist():
        fits = (label[right] != label[x]) & (~outside[right] | (rank[right] > rank[x]))
        fits &= np.minimum(size[right], size[x]) >= SIMILARITY * np.maximum(size[right], size[x])
        others = right[fits]
        same = sigs[others] == sigs[x]
        kept = same.mean(axis=1) >= ESTIMATE
        shared = same[kept].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)  # the lowest band of both
        others = others[kept][shared == band]
        if not len(others):
            continue
        both = _overlaps(bags[x], [bags[y] for y in others.tolist()])
        for y in others[both >= SIMILARITY * (size[others] + size[x] - both)].tolist():
            if label[y] != label[x]:
                found.append((nodes[x], nodes[y]))
                label[label == label[y]] = label[x]
    return pa.table({c: pa.array([r[k] for r in found], pa.binary()) for k, c in enumerate(("a", "b"))})


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            both, either = overlap(_unpacked(x), _unpacked(y))
            linked.append(both >= SIMILARITY * either)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(
            pa.array(linked, pa.bool_())
        )


def _with_both(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """``a, b`` with the value of each."""
    left = values.select(F.col("node").alias("a"), F.col(column).alias("x"))
    right = values.select(F.col("node").alias("b"), F.col(column).alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` of all nodes of ``a, b`` edges: the lowest node that links lead to.

    Every round takes the lowest label around, then the label of that label; rounds go on
    until none changes.  Labels are broadcast if their size allows it, else shuffled.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.distinct(), "edges")
    parts = 1 + both.count() // PART_ROWS  # small graphs are not worth many tasks

    def stored(labels: DataFrame) -> DataFrame:
        return materialize(labels.coalesce(parts), "labels")

    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp")))
    while True:
        known = broadcast_if_small(labels)
        around = both.join(known.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        near = around.join(known, F.col("a") == F.col("node")).select("node", F.least("comp", "m").alias("m"), "comp")
        far = known.select(F.col("node").alias("m"), F.col("comp").alias("next"))
        step = near.join(far, "m").select("node", F.least("m", "next").alias("comp"), F.col("comp").alias("old"))
        step = stored(step.select("node", "comp", (F.col("comp") != F.col("old")).alias("moved")))
        labels = step.select("node", "comp")
        if step.where("moved").isEmpty():
            return labels


class _Search:
    """Buckets, signatures, bags, and what has been compared so far."""

    def __init__(self, docs: DataFrame, sketches: DataFrame, text: str) -> None:
        placed = sketches.where(F.col("node").isNotNull()).select(F.posexplode("bands").alias("band", "bucket"), "node")
        sized = placed.distinct()
        shared = sized.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
        self.buckets = materialize(sized.join(shared, "bucket"), "buckets")
        nodes = materialize(self.buckets.select("node").distinct(), "shared-nodes")
        wanted = broadcast_if_small(nodes)
        self.sigs = materialize(
            sketches.select("node", "sig").join(wanted, "node", "left_semi").dropDuplicates(["node"]), "signatures"
        )
        # one row of every node is enough for its bag
        keys = sketches.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key"))
        keys = materialize(keys.select("key").distinct(), "shared-keys")
        rows = docs.select("key", F.col(text).alias("text")).join(broadcast_if_small(keys), "key", "left_semi")
        bags = rows.select("text").mapInArrow(_bags, "node binary, bag binary")
        self.bags = materialize(bags.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "bags")
        self.tested: DataFrame | None = None
        self.edges: DataFrame | None = None

    def _new(self, pairs: DataFrame) -> DataFrame:
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.tested is not None:
            ordered = ordered.join(self.tested, ["a", "b"], "left_anti")
        new = materialize(ordered, "pairs")
        self.tested = new if self.tested is None else self.tested.union(new)
        return new

    def compare(self, pairs: DataFrame) -> DataFrame:
        """Links among pairs that are new."""
        both = _with_both(self._new(pairs), self.sigs, "sig")
        close = materialize(both.mapInArrow(_close_signatures, "a binary, b binary"), "close")
        return _with_both(close, self.bags, "bag").mapInArrow(_similar, "a binary, b binary")

    def keep(self, links: DataFrame) -> bool:
        """Store links; whether there are any."""
        links = materialize(links, "links")
        self.edges = links if self.edges is None else self.edges.union(links)
        return not links.isEmpty()

    def labelled(self, labels: DataFrame | None) -> DataFrame:
        """``bucket, band, node, comp, n`` of the buckets that hold several components."""
        placed = self.buckets.withColumn("comp", F.col("node"))
        if labels is not None:
            joined = self.buckets.join(labels, "node", "left")
            placed = joined.select("bucket", "band", "node", F.coalesce("comp", "node").alias("comp"))
        placed = materialize(placed, "placed")
        mixed = placed.groupBy("bucket").agg(
            F.min("comp").alias("low"),
            F.max("comp").alias("high"),
            F.count("*").alias("n"),
            F.min_by(F.struct("node", "comp"), F.xxhash64("node")).alias("hub"),
        )
        mixed = mixed.where(F.col("low") != F.col("high")).select("bucket", "n", "hub")
        return placed.join(mixed, "bucket")

    def in_blocks(self, placed: DataFrame) -> DataFrame:
        """Links of large buckets, found in blocks of members outside the largest component and
        blocks of all members."""
        large = materialize(placed.where(F.col("n") > SMALL_BUCKET).select("bucket", "band", "node", "comp"), "large")
        sized = large.join(self.bags.select("node", F.octet_length("bag").alias("bytes")), "node")
        sizes = sized.groupBy("bucket", "comp").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
        n_blocks = lambda n, b: F.greatest(F.ceil(n / BLOCK_ROWS), F.ceil(b / BLOCK_BYTES)).cast("int")
        top = F.max_by(F.struct("comp", "n", "bytes"), F.struct("n", "comp")).alias("top")
        bounds = sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), top).select(
            "bucket",
            F.col("top.comp").alias("largest"),
            F.greatest(n_blocks(F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top.bytes")), F.lit(1)).alias("n_left"),
            n_blocks(F.col("n"), F.col("bytes")).alias("n_right"),
        )
        members = large.join(bounds, "bucket").withColumn("outside", F.col("comp") != F.col("largest"))
        own = lambda n: F.pmod(F.xxhash64("node", F.lit(1)), n).cast("int")
        place = lambda side, i, j: F.struct(F.lit(side).alias("side"), i.alias("i"), j.alias("j"))
        up_to = lambda n: F.sequence(F.lit(0), n - 1)
        left = F.when(F.col("outside"), F.transform(up_to(F.col("n_right")), lambda j: place(0, own(F.col("n_left")), j)))
        right = F.transform(up_to(F.col("n_left")), lambda i: place(1, i, own(F.col("n_right"))))
        met = members.join(self.sigs, "node").join(self.bags, "node")
        nothing = F.array().cast("array<struct<side:int,i:int,j:int>>")
        met = met.select("*", F.explode(F.concat(F.coalesce(left, nothing), right)).alias("at"))
        met = met.select("bucket", "band", "node", "comp", "outside", "sig", "bag", "at.side", "at.i", "at.j")
        return met.groupBy("bucket", "i", "j").applyInArrow(_links, "a binary, b binary")


def node_classes(docs: DataFrame, sketches: DataFrame, text: str = "text") -> DataFrame | None:
    """``node, comp`` of all nodes that are linked to another one."""
    search = _Search(docs, sketches, text)
    labels = None
    placed = search.labelled(labels)
    apart = placed.where(F.col("comp") != F.col("hub.comp"))
    if search.keep(search.compare(apart.select(F.col("node").alias("a"), F.col("hub.node").alias("b")))):
        labels = components(search.edges)
    placed = search.labelled(labels)
    small = placed.where(F.col("n") <= SMALL_BUCKET).select("bucket", "node", "comp")
    other = small.select("bucket", F.col("node").alias("b"), F.col("comp").alias("other"))
    crossed = small.join(other, "bucket").where(F.col("comp") < F.col("other"))
    links = search.compare(crossed.select(F.col("node").alias("a"), "b"))
    if search.keep(links.unionByName(search.in_blocks(placed))):
        labels = components(search.edges)
    return labels


def _row_classes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, node, comp, class_id`` of every row that has an id; stored in the scratch folder."""
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    sketches = rows.mapInArrow(_sketches, "key long, node binary, bands array<long>, sig binary")
    sketches = materialize(sketches, "sketches")
    labels = node_classes(rows, sketches)
    # one row per class of equal bags before anything is joined, so copies make no hot key
    firsts = sketches.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("key").alias("first"))
    if labels is None:
        classes = firsts.select("node", F.col("node").alias("comp"), F.col("first").alias("class_id"))
    else:
        named = materialize(firsts.join(labels, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"), "first"), "named")
        lowest = named.groupBy("comp").agg(F.min("first").alias("class_id"))
        classes = named.join(lowest, "comp").select("node", "comp", "class_id")
    found = sketches.select("key", "node").join(classes, "node", "left")
    return materialize(found.select("key", "node", "comp", F.coalesce("class_id", "key").alias("class_id")), "classes")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, class_id`` of every row that has an id."""
    return _row_classes(docs, key, text).select(F.col("key").alias(key), "class_id")


def _named_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 1, SLICE_BYTES):
        owner, value = shingles(batch.column(1))
        nodes = pa.array(_nodes(owner, value, batch.num_rows), pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, nodes], ["key", "text", "node"])


def without_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class, that of its lowest id; rows without an id stay.

    Of an id with several texts each text is judged by itself, and equal rows are one.
    """
    classes = _row_classes(docs, key, text)
    again = docs.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("__again")).count().where("count > 1")
    again = materialize(again.select("__again"), "repeated-ids")
    marked = broadcast_if_small(again)
    single = classes.where(F.col("key") != F.col("class_id")).join(marked, F.col("key") == F.col("__again"), "left_anti")
    gone = materialize(single.select(F.col("key").alias("__gone")), "gone")
    kept = docs.join(broadcast_if_small(gone), F.col(key) == F.col("__gone"), "left_anti")
    if again.isEmpty():
        return kept
    rows = kept.join(marked, F.col(key) == F.col("__again"), "left_semi")
    texts = rows.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).distinct()
    named = texts.mapInArrow(_named_nodes, "key long, text string, node binary")
    first = classes.where(F.col("key") == F.col("class_id")).select(F.col("key").alias("k"), F.col("node").alias("n"), "comp").distinct()
    held = named.join(first, (F.col("key") == F.col("k")) & F.col("node").eqNullSafe(F.col("n")))
    alone = F.when(F.col("node").isNull(), F.struct("text"))  # texts without words are classes of their own
    chosen = held.groupBy(F.col("key").alias("__key"), "comp", alone.alias("alone")).agg(F.min("text").alias("__text"))
    chosen = materialize(chosen.select("__key", "__text"), "chosen")
    here = (F.col(key) == F.col("__key")) & F.col(text).eqNullSafe(F.col("__text"))
    one = rows.join(broadcast_if_small(chosen), here, "left_semi").dropDuplicates([key, text])
    return kept.join(marked, F.col(key) == F.col("__again"), "left_anti").unionByName(one)
